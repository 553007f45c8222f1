"""BPE over a public vocabulary file: merge lookahead, windowed encoder,
incremental decoder.

Merges happen inside pre-tokens. The *sufficient lookahead* of a merge list is
the number of symbols after a token's end that can still change the token: a
merge (a, b) can be kept from its b only by an earlier merge (c, d) where c
closes b (c is on the right edge of b's merge tree) and d follows, which in
turn can be kept from its d, and so on with ever earlier merges. One pass over
the list gives the longest such chain. A token that ends at least that many
symbols before the end of what is read is final.
"""
from __future__ import annotations

import codecs
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import regex
from tokenizers import Tokenizer

#: Runs kept with their ids in a worker, and the longest run kept.
CACHE_WORDS, CACHE_CHARS = 400_000, 48
#: Characters whose new words are merged together.
BLOCK = 1 << 21
#: Characters of text taken at once (more where no white space follows).
PIECE = 1 << 16
#: Ids decoded at once.
ID_BLOCK = 1 << 14

_SPACE = regex.compile(r"\p{White_Space}")
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def _unsure() -> re.Pattern:
    """Characters on which Unicode versions may part: those that this Python
    does not know, and those younger than Unicode 3.2 that combine (a combining
    class, a canonical decomposition, or a part of one). The library, whose
    tables are of other versions, is asked about the text around them. Beyond
    the first plane it is always asked: one range makes the search quicker."""
    unsure = np.zeros(0x110000, bool)
    unsure[0x10000:] = True
    for c in range(0x10000):
        x = chr(c)
        if unicodedata.category(x) == "Cn":
            unsure[c] = True
        elif unicodedata.ucd_3_2_0.category(x) == "Cn":
            parts = unicodedata.decomposition(x)
            if unicodedata.combining(x):
                unsure[c] = True
            elif parts and not parts.startswith("<"):
                unsure[[c, *[int(p, 16) for p in parts.split() if int(p, 16) > 0x3FF]]] = True
    edges = np.flatnonzero(np.diff(unsure, prepend=False, append=False))
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2).tolist()) + "]")


_UNSURE = _unsure()


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, others for 256, 257, ..."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, more = [""] * 256, 256
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b] = chr(more)
            more += 1
    return out


class MergeTable:
    """Vocabulary, merge ranks and lookahead of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.pair[vocab[a], vocab[b]] = (rank, vocab[a + b])
        letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.byte_id = [vocab[x] for x in letters]
        self.last_id = [vocab[x + self.end] for x in letters]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for s, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = s
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split)
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.lookahead = self._lookahead()
        self._arrays()

    def pre_tokens(self, run: str) -> list[str]:
        """Pre-tokens of a run without white space; the library says them where
        the run has a character on which Unicode versions may part."""
        if run.isascii() or not _UNSURE.search(run):
            return self.split.findall(run)
        return [bytes(self.byte_of[c] for c in letters).decode()
                for letters, _ in self.library.pre_tokenizer.pre_tokenize_str(run)]

    def size(self, token: int) -> int:
        s = self.token[token]
        return len(s) - len(self.end) if self.end and s.endswith(self.end) and s != self.end else len(s)

    def _lookahead(self) -> int:
        right: dict[int, list[int]] = {}      # right operands of the merges that make a token
        after: dict[int, int] = {}            # longest chain that starts with this token as left operand
        for (a, b), (_, made) in self.pair.items():
            edge, todo = set(), [b]
            while todo:
                x = todo.pop()
                if x not in edge:
                    edge.add(x)
                    todo += right.get(x, ())
            chain = self.size(b) + max(after.get(x, 0) for x in edge)
            after[a] = max(after.get(a, 0), chain)
            right.setdefault(made, []).append(b)
        return max(after.values(), default=1)

    def merge(self, ids: list[int]) -> list[int]:
        """All merges of a symbol sequence, lowest rank first."""
        pair = self.pair
        while len(ids) > 1:
            found = [pair.get(x, _NEVER) for x in zip(ids, ids[1:], strict=False)]
            best = min(found)
            if best is _NEVER:
                break
            out, i, n = [], 0, len(ids)
            while i < n:
                if i < n - 1 and found[i][0] == best[0]:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian 32 bits each) of whole pre-tokens, all words of
        one length at a time: each round does the first merge of every word."""
        out: list[bytes] = [b""] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(len(w), []).append(i)
        for size, members in by_size.items():
            for at in range(0, len(members), 1 << 15):
                part = members[at:at + (1 << 15)]
                raw = np.frombuffer(b"".join([words[i] for i in part]), np.uint8).reshape(-1, size)
                ids = self._byte_ids[raw]
                ids[:, -1] = self._last_ids[raw[:, -1]]
                self._rounds(ids, np.array(part), out)
        return out

    def _rounds(self, ids: np.ndarray, who: np.ndarray, out: list[bytes]) -> None:
        while len(ids):
            if ids.shape[1] > 1:
                key = ids[:, :-1] << 16 | ids[:, 1:]
                at = np.searchsorted(self._keys, key)
                at[at == len(self._keys)] = 0
                rank = np.where(self._keys[at] == key, self._ranks[at], _LAST)
                best = rank.min(1)
                done = best == _LAST
            else:
                done = np.ones(len(ids), bool)
            if done.any():
                ended = ids[done]
                real = ended != _PAD
                raw = ended[real].astype("<u4").tobytes()
                stop = 4 * np.cumsum(real.sum(1))
                start = 0
                for i, e in zip(who[done].tolist(), stop.tolist(), strict=True):
                    out[i] = raw[start:e]
                    start = e
                if done.all():
                    return
                ids, who, rank, best = ids[~done], who[~done], rank[~done], best[~done]
            hit = rank == best[:, None]
            for c in range(1, hit.shape[1]):
                hit[:, c] &= ~hit[:, c - 1]
            r, c = np.nonzero(hit)
            ids[r, c] = self._made[best[r]]
            stay = np.ones(ids.shape, bool)
            stay[r, c + 1] = False
            place = np.cumsum(stay, 1) - 1
            moved = np.full(ids.shape, _PAD, np.int64)
            rows, cols = np.nonzero(stay)
            moved[rows, place[rows, cols]] = ids[rows, cols]
            used = int((moved != _PAD).sum(1).max())
            ids = moved[:, :used]

    def _arrays(self) -> None:
        key = np.array([a << 16 | b for a, b in self.pair], np.int64)
        ranks = np.array([r for r, _ in self.pair.values()], np.int64)
        order = np.argsort(key)
        self._keys, self._ranks = key[order], ranks[order]
        self._made = np.zeros(len(ranks), np.int64)
        self._made[ranks] = [m for _, m in self.pair.values()]
        self._byte_ids, self._last_ids = np.array(self.byte_id, np.int64), np.array(self.last_id, np.int64)


_NEVER = (1 << 60, -1)
#: Padding id (no token of a vocabulary below 2^16 - 1) and the rank of no merge.
_PAD, _LAST = (1 << 16) - 1, 1 << 40


class StreamEncoder:
    """Ids of texts as the tokenizers library gives them for the file."""

    def __init__(self, table: MergeTable):
        self.table = table
        self.window = 4 * table.lookahead
        self.known: dict[str, bytes] = {}

    def symbols(self, word: bytes) -> Iterator[int]:
        """Ids of one pre-token. Symbols enter a window; the window is merged,
        the tokens that end a lookahead before its end go out, and what is
        left begins at a true token boundary, so it is merged anew alone."""
        t, n = self.table, len(word)
        byte_id, at, held = t.byte_id, 0, 0
        while at < n:
            stop = min(at + self.window, n)
            ids = [byte_id[b] for b in word[at:stop]]
            if stop == n:
                ids[-1] = t.last_id[word[n - 1]]
                yield from t.merge(ids)
                return
            held = at
            for x in t.merge(ids):
                size = t.size(x)
                if held + size + t.lookahead > stop:
                    break
                yield x
                held += size
            at = held

    def learn(self, runs: set[str]) -> dict[str, bytes]:
        """Ids of runs without white space: pre-tokens of up to a window are
        merged together, longer ones go through ``symbols`` one by one."""
        parts = {}
        todo: dict[str, bytes] = {}
        for run in runs:
            parts[run] = got = self.table.pre_tokens(run)
            for p in got:
                todo[p] = b""
        short = [p for p in todo if len(p) <= CACHE_CHARS]
        todo.update(zip(short, self.table.merge_many([p.encode() for p in short]), strict=True))
        for p in todo:
            if len(p) > CACHE_CHARS:
                todo[p] = np.fromiter(self.symbols(p.encode()), "<u4").tobytes()
        return {run: b"".join([todo[p] for p in got]) for run, got in parts.items()}

    def plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special strings."""
        find, split, found, new = self.known.get, [], [], set()
        for text in texts:
            runs = self._runs(text)
            got = list(map(find, runs))
            if None in got:
                new.update([r for r, x in zip(runs, got, strict=True) if x is None])
                split.append(runs)
            else:
                split.append(None)
            found.append(got)
        fresh = self.learn(new) if new else {}
        out = [b"".join(got if runs is None else [fresh[r] if x is None else x for r, x in zip(runs, got, strict=True)])
               for runs, got in zip(split, found, strict=True)]
        if len(self.known) + len(fresh) > CACHE_WORDS:
            self.known.clear()
        self.known.update((r, x) for r, x in fresh.items() if len(r) <= CACHE_CHARS)
        return out

    def _runs(self, text: str) -> list[str]:
        if not text.isascii():
            if _UNSURE.search(text):
                return [r for r in self.table.library.normalizer.normalize_str(text).split(" ") if r]
            # lower-casing works on single characters: no final sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return text.split() if not _ODD_SPACE.search(text) else [r for r in _SPACE.split(text) if r]

    def pieces(self, text: str) -> Iterator[str]:
        """Parts of a text cut after ASCII white space, which no token, special
        string or composed character crosses."""
        at, n = 0, len(text)
        while n - at > PIECE:
            m = _CUT.search(text, at + PIECE)
            if not m:
                break
            yield text[at:m.end()]
            at = m.end()
        yield text[at:] if at else text

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, little-endian 32 bits each. Texts are taken in pieces
        of bounded size; only the ids of a text are kept whole."""
        special, out = self.table.special, [[] for _ in texts]
        plain, owner, size = [], [], 0

        def flush() -> None:
            for i, ids in zip(owner, self.plain(plain), strict=True):
                out[i].append(ids)
            plain.clear()
            owner.clear()

        for i, text in enumerate(texts):
            for piece in self.pieces(text):
                parts = [piece] if "<" not in piece else self.table.special_split.split(piece)
                for part in parts:
                    if part in special:
                        flush()
                        out[i].append(np.array([special[part]], "<u4").tobytes())
                    elif part:
                        plain.append(part)
                        owner.append(i)
                        size += len(part)
                if size > BLOCK:  # bounds memory, also within one text
                    flush()
                    size = 0
        flush()
        return [b"".join(x) for x in out]


_CUT = re.compile("[ \t\n\r\x0b\x0c]")


class StreamDecoder:
    """Text of ids, fed block by block.

    ``form="library"``: as the file's own decode, which has no decoder and so
    gives vocabulary strings with spaces between. ``form="text"``: bytes of
    the tokens, a space at word ends, through an incremental UTF-8 machine that
    holds at most three bytes of an open character between blocks."""

    def __init__(self, table: MergeTable, form: str = "library"):
        self.form, self.token = form, table.token
        self.started = False
        if form == "text":
            byte_of = table.byte_of
            special = set(table.special.values())
            end = table.end
            self.bytes = []
            for i, s in enumerate(table.token):
                if i in special:
                    self.bytes.append(s.encode() + b" ")
                    continue
                word_end = bool(end) and s.endswith(end)
                body = s[:-len(end)] if word_end else s
                self.bytes.append(bytes(byte_of[c] for c in body) + b" " * word_end)
            self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        if self.form == "text":
            table = self.bytes
            return self.machine.decode(b"".join([table[i] for i in ids]))
        if not ids:
            return ""
        token = self.token
        out = (" " if self.started else "") + " ".join([token[i] for i in ids])
        self.started = True
        return out

    def close(self) -> str:
        return self.machine.decode(b"", True) if self.form == "text" else ""


def decode(table: MergeTable, ids: np.ndarray, form: str = "library") -> str:
    machine = StreamDecoder(table, form)
    parts = [machine.feed(ids[i:i + ID_BLOCK].tolist()) for i in range(0, len(ids), ID_BLOCK)]
    return "".join([*parts, machine.close()])


_loaded: dict[str, tuple[MergeTable, StreamEncoder]] = {}


def load(path: str) -> tuple[MergeTable, StreamEncoder]:
    """The table and an encoder of a worker process."""
    if path not in _loaded:
        table = MergeTable(path)
        _loaded[path] = table, StreamEncoder(table)
    return _loaded[path]


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies on this machine; a name with a slash
    is a path already."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def take(strings: Iterable) -> list[str]:
    return ["" if x is None else x for x in strings]
