"""Lattice of all segmentations of words into the pieces of a vocabulary.

Words of one length are handled together: all their substrings that are pieces
become edges; the forward recursion adds, in log space, the probabilities of
all edges that end at a place. The result is the marginal probability of the
word over all segmentations. Characters that are no piece are spelled with byte
pieces.
"""
from __future__ import annotations

from collections import defaultdict

import numpy as np

from reelhouse.llm.common import golden

MARK = "▁"
#: Words handled at once, and the characters of words that are (longer words go one by one).
GROUP, LONG = 4096, 48
_P = golden(12345) | np.uint64(1)
_FILTER = np.uint64(64 - 20)


class Lattice:
    def __init__(self, pieces: list[str], byte_pieces: list[int], log_p: np.ndarray):
        self.pieces, self.byte_pieces, self.log_p = pieces, byte_pieces, log_p
        skip = set(byte_pieces)
        by_size: dict[int, list[int]] = defaultdict(list)
        for i, p in enumerate(pieces):
            if i not in skip and p:
                by_size[len(p)].append(i)
        self.tables = {}
        for size, ids in sorted(by_size.items()):
            codes = self._codes([pieces[i] for i in ids], size)
            h = np.zeros(len(ids), np.uint64)
            for c in range(size):
                h = h * _P + codes[:, c]
            order = np.argsort(h)
            seen = np.zeros(1 << 20, bool)
            seen[(h * _P) >> _FILTER] = True
            self.tables[size] = h[order], np.array(ids)[order], seen
        self.longest = max(self.tables, default=1)

    @staticmethod
    def _codes(words: list[str], size: int) -> np.ndarray:
        raw = "".join(words).encode("utf-32-le")
        return np.frombuffer(raw, "<u4").astype(np.uint64).reshape(-1, size)

    def _edges(self, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """word, start, end, piece, log probability of every edge. Pieces from
        ``len(pieces)`` on are characters spelled with bytes."""
        n, size = codes.shape
        words, starts, sizes, ids = [], [], [], []
        h = np.zeros((n, size + 1), np.uint64)
        single = np.zeros((n, size), bool)
        for m in range(1, min(self.longest, size) + 1):
            h = h[:, :size - m + 1] * _P + codes[:, m - 1:]
            if m not in self.tables:
                continue
            known, piece, seen = self.tables[m]
            w, s = np.nonzero(seen[(h * _P) >> _FILTER])
            at = np.minimum(np.searchsorted(known, h[w, s]), len(known) - 1)
            ok = known[at] == h[w, s]
            w, s, at = w[ok], s[ok], at[ok]
            if m == 1:
                single[w, s] = True
            words.append(w)
            starts.append(s)
            sizes.append(np.full(len(w), m))
            ids.append(piece[at])
        self.spelled: list[bytes] = []
        w, s = np.nonzero(~single)
        extra = np.zeros(0)
        if len(w):
            chars, back = np.unique(codes[w, s], return_inverse=True)
            self.spelled = [chr(int(c)).encode("utf-8", "surrogatepass") for c in chars]
            extra = np.array([sum(self.log_p[self.byte_pieces[b]] for b in x) for x in self.spelled])
            words.append(w)
            starts.append(s)
            sizes.append(np.ones(len(w), np.int64))
            ids.append(len(self.pieces) + back)
        word, start, piece = np.concatenate(words), np.concatenate(starts), np.concatenate(ids)
        return word, start, start + np.concatenate(sizes), piece, np.concatenate([self.log_p, extra])[piece]

    @staticmethod
    def _sweep(n: int, size: int, word, start, end, lp) -> np.ndarray:
        alpha = np.full((n, size + 1), -np.inf)
        alpha[:, 0] = 0
        order = np.argsort(end, kind="stable")
        word, start, lp = word[order], start[order], lp[order]
        cut = np.searchsorted(end[order], np.arange(1, size + 2))
        for j in range(1, size + 1):
            e = slice(cut[j - 1], cut[j])
            w = word[e]
            v = alpha[w, start[e]] + lp[e]
            top = np.full(n, -np.inf)
            np.maximum.at(top, w, v)
            base = np.where(np.isfinite(top), top, 0)
            with np.errstate(divide="ignore"):
                alpha[:, j] = np.log(np.bincount(w, np.exp(v - base[w]), n)) + base
        return alpha

    def _groups(self, words: list[str]):
        by_size: dict[int, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            by_size[len(w) + 1].append(i)
        for size, members in by_size.items():
            step = max(1, GROUP * LONG // max(size, LONG) // (1 + size // 256))
            for at in range(0, len(members), step):
                part = members[at:at + step]
                yield part, self._codes([MARK + words[i] for i in part], size)

    def log_prob(self, words: list[str]) -> np.ndarray:
        """Natural logarithm of the marginal probability of each word."""
        out = np.zeros(len(words))
        for part, codes in self._groups(words):
            word, start, end, _, lp = self._edges(codes)
            out[part] = self._sweep(*codes.shape, word, start, end, lp)[:, -1]
        return out

    def expected(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in the weighted words."""
        out = np.zeros(len(self.pieces))
        for part, codes in self._groups(words):
            n, size = codes.shape
            word, start, end, piece, lp = self._edges(codes)
            alpha = self._sweep(n, size, word, start, end, lp)
            beta = self._sweep(n, size, word, size - end, size - start, lp)[:, ::-1]
            post = np.exp(alpha[word, start] + lp + beta[word, end] - alpha[word, -1]) * weights[part][word]
            use = np.bincount(piece, post, len(self.pieces) + len(self.spelled))
            out += use[:len(self.pieces)]
            for x, u in zip(self.spelled, use[len(self.pieces):], strict=True):
                for b in x:
                    out[self.byte_pieces[b]] += u
        return out


def vocabulary(path: str) -> tuple[list[str], list[int], np.ndarray]:
    """Pieces, ids of the 256 byte pieces and starting log probabilities of a
    sentencepiece file. The scores of its pieces are ranks (0, -1, -2, ...) or
    log probabilities; ranks are taken as a Zipf law. Control pieces and runs
    of word marks are left out; byte pieces weigh as much as the last piece."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, is_byte = [], [], []
    for i in range(model.get_piece_size()):
        p = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or MARK in p[1:]:
            continue
        pieces.append("" if model.is_byte(i) else p)
        is_byte.append(int(p[3:5], 16) if model.is_byte(i) else -1)
        scores.append(model.get_score(i))
    score, byte = np.array(scores), np.array(is_byte)
    real = score[byte < 0]
    ranks = np.all(real == np.round(real)) and real.min() < -1000
    log_p = -np.log1p(-score + 1) if ranks else score
    log_p[byte >= 0] = log_p[byte < 0].min()
    log_p -= np.log(np.exp(log_p).sum())
    at = np.full(256, -1)
    at[byte[byte >= 0]] = np.flatnonzero(byte >= 0)
    return pieces, at.tolist(), log_p
