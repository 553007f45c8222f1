"""Spelling variants: words one edit apart, by dense prefix and suffix lengths.

Two words of lengths L - 1 or L, L the longer, differ by one edit exactly if
their common prefix and common suffix together reach L - 1. The edit lies in
one of ``PIECES`` parts of the L places; both words then agree before and after
that part. So each word is dealt, for L its own length and one more and for
each part, to the group of the words with the same rest. Within a group all
words are compared as padded matrices of code points, left- and right-aligned;
a pair counts in the group of its first differing place only, so no pair is
found twice. Groups over ``BLOCK`` words are cut into blocks and dealt again by
pair of blocks.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import materialize, texts

#: Code points of a word and its occurrences at least; a form is so many times as frequent.
SHORTEST, LEAST, TIMES = 7, 2, 10
#: Runs whose hash this divides lose a code point.
DROP = 31
PIECES, BLOCK = 4, 2048
#: Cells of the matrices compared at once.
CELLS = 1 << 23
#: Distinct words a task counts before it passes them on.
FLUSH = 300_000
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % SHORTEST)      # a maximal run, or none of it


def _count(batches):
    seen: Counter = Counter()

    def out():
        batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                           names=["word", "n"])
        seen.clear()
        return batch

    for batch in batches:
        for ident, text in zip(batch.column("id").to_pylist(), texts(batch.column("text")), strict=True):
            mark = zlib.crc32(f"{ident or ''}:".encode())
            for run, n in Counter(_RUN.findall(text.lower().decode())).items():
                h = zlib.crc32(run.encode(), mark)
                if h % DROP == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < SHORTEST:
                        continue
                seen[run] += n
            if len(seen) > FLUSH:
                yield out()
    if seen:
        yield out()


def bounds(size: int) -> list[int]:
    """First places of the parts of a word, and its end."""
    return [size * k // PIECES for k in range(PIECES + 1)]


def _deal(batches):
    """A row for each group of a word: hash of what the group shares, longer length, part."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        at, key, longer, part = [], [], [], []
        for k, word in enumerate(words):
            raw = word.encode("latin-1")
            for size in (len(raw), len(raw) + 1):
                cut = bounds(size)
                for j in range(PIECES):
                    rest = raw[:cut[j]] + b"\0" + raw[len(raw) - size + cut[j + 1]:]
                    at.append(k)
                    key.append(xxhash.xxh3_64_intdigest(rest, size * PIECES + j) - (1 << 63))
                    longer.append(size)
                    part.append(j)
        at = pa.array(at, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(longer, pa.int32()), pa.array(part, pa.int8()),
             batch.column("word").take(at), batch.column("n").take(at)], names=["key", "longer", "part", "word", "n"])


def _matrices(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points left- and right-aligned, padded with 0, and lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    width = int(size.max()) + 1
    left = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    right = np.frombuffer(b"".join(w.rjust(width, b"\0") for w in words), np.uint8).reshape(-1, width)[:, ::-1]
    return left, right, size


def near(words: list[bytes], group: np.ndarray, longer: np.ndarray, part: np.ndarray,
         side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of one group that are one edit apart, the longer of
    length ``longer``, with the first differing place in ``part``. ``side`` is 0
    where a row meets all others of its group; rows of side 1 meet those of side
    2 only. Rows of a group are next to each other."""
    left, right, size = _matrices(words)
    n, width = left.shape
    found = []
    step = max(1, CELLS // width)
    last = np.searchsorted(group, group, "right")          # first row of the next group
    for d in range(1, int((last - np.arange(n)).max(initial=1))):
        rows = np.flatnonzero(last > np.arange(n) + d)
        for lo in range(0, len(rows), step):
            i = rows[lo:lo + step]
            j = i + d
            most = np.maximum(size[i], size[j])
            ok = (most == longer[i]) & (np.abs(size[i] - size[j]) <= 1) & ((side[i] == 0) | (side[i] != side[j]))
            i, j, most = i[ok], j[ok], most[ok]
            if len(i):
                p = np.argmin(left[i] == left[j], 1)
                s = np.argmin(right[i] == right[j], 1)
                ok = (p + s >= most - 1) & (most * part[i] // PIECES <= p) & (p < most * (part[i] + 1) // PIECES)
                found.append((i[ok], j[ok]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _compare(batches):
    """Links of the groups in a sorted partition, both ways."""
    def settle(key, longer, part, side, words, n):
        change = np.ones(len(key), bool)
        change[1:] = (key[1:] != key[:-1]) | (longer[1:] != longer[:-1]) | (part[1:] != part[:-1])
        group = np.cumsum(change)
        alone = (np.bincount(group)[group] == 1)
        take = np.flatnonzero(~alone)
        if not len(take):
            return None
        raw = [words[k].encode("latin-1") for k in take]
        i, j = near(raw, group[take], longer[take], part[take], side[take])
        if not len(i):
            return None
        i, j = take[i], take[j]
        names, n = pa.array(words, pa.string()), pa.array(n)
        a, b = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
        return pa.RecordBatch.from_arrays([names.take(a), names.take(b), n.take(b)], names=["word", "other", "n"])

    held: list = []
    cells = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            rest = batch.slice(at)
            widest = int(np.asarray(rest.column("longer")).max()) + 1
            take = min(rest.num_rows, max(1, CELLS // widest))
            held.append(rest.slice(0, take))
            cells += take * widest
            at += take
            if cells >= CELLS:       # settle up to the last place where the key changes
                table = pa.Table.from_batches(held)
                key = table.column("key").to_numpy()
                end = int(np.searchsorted(key, key[-1], "left")) if key[0] != key[-1] else 0
                if end:
                    out = settle(*_columns(table.slice(0, end)))
                    if out is not None:
                        yield out
                    held = table.slice(end).to_batches()
                    cells = (len(key) - end) * widest
    if held:
        out = settle(*_columns(pa.Table.from_batches(held)))
        if out is not None:
            yield out


def _columns(table: pa.Table):
    number = [table.column(c).to_numpy() for c in ("key", "longer", "part", "side")]
    return number[0], number[1].astype(np.int64), number[2].astype(np.int64), number[3].astype(np.int64), \
        table.column("word").to_pylist(), table.column("n").to_numpy()


def links(words: DataFrame) -> DataFrame:
    """word, other, n (of the other): every link between words one edit apart, both ways."""
    dealt = words.mapInArrow(_deal, "key long, longer int, part byte, word string, n long")
    large = (words.select("word", F.lit(0).cast("long").alias("n")).mapInArrow(
        _deal, "key long, longer int, part byte, word string, n long").groupBy("key").count().where(F.col("count") > BLOCK)
        .select("key", F.ceil(F.col("count") / BLOCK).cast("long").alias("blocks")))
    large = materialize(large, "large-groups")
    if large.isEmpty():
        dealt = dealt.withColumn("side", F.lit(0).cast("byte"))
    else:
        own = F.pmod(F.xxhash64("word"), F.col("blocks"))
        meets = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: F.struct(
            F.least(b, F.col("own")).alias("a"), F.greatest(b, F.col("own")).alias("b"),
            F.when(b == F.col("own"), 0).when(F.col("own") < b, 1).otherwise(2).cast("byte").alias("side")))
        alone = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
                                 F.lit(0).cast("byte").alias("side")))
        dealt = (dealt.join(large, "key", "left").withColumn("own", own)
                 .withColumn("m", F.explode(F.when(F.col("blocks").isNull(), alone).otherwise(meets)))
                 .select(F.when(F.col("blocks").isNull(), F.col("key")).otherwise(
                     F.xxhash64("key", "m.a", "m.b")).alias("key"), "longer", "part", "word", "n", "m.side"))
    return (dealt.repartition("key").sortWithinPartitions("key", "longer", "part")
            .mapInArrow(_compare, "word string, other string, n long"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last form reached from each word that has one. A form is
    ``TIMES`` as frequent as its word, so there are at most as many rounds as
    the largest count has digits."""
    step = forms.select(F.col("word").alias("root"), F.col("form").alias("onward"))
    going, done = forms.select("word", F.col("form").alias("root")), None
    while True:
        moved = materialize(going.join(step, "root", "left"), "roots")
        ended = moved.where(F.col("onward").isNull()).select("word", "root")
        done = ended if done is None else done.unionByName(ended)
        going = moved.where(F.col("onward").isNotNull()).select("word", F.col("onward").alias("root"))
        if going.isEmpty():
            return done


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n, root.

    Runs ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts with A-Z lowered; where 31
    divides the crc32 of ``<id>:<run>``, the run loses one code point. Words are
    the results of at least 7 code points and 2 occurrences. ``n_near`` counts
    the words one inserted, deleted or replaced code point away. ``form`` is the
    near word of largest n (ties: smallest in code-point order) if that is at
    least ten times n, ``root`` the last of the forms from there on, the word
    itself without any. Null texts have no words; a null id counts as ''; rows
    that repeat count again. An empty table gives an empty table. Other columns
    are not read."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    words = materialize(rows.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
                        .where(F.col("n") >= LEAST), "words")
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("other").alias("other")))
    beside = links(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    large = -F.col("best.less") >= TIMES * F.col("n")
    found = materialize(words.join(beside, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(large, F.col("best.other")).alias("form"),
        F.when(large, -F.col("best.less")).alias("form_n")), "variants")
    forms = found.where(F.col("form").isNotNull()).select("word", "form")
    return found.join(roots(forms), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
