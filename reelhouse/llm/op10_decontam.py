"""Benchmark decontamination with spaced seeds.

A mask is laid over every window of words; the words under its ones are hashed,
those under its zeros may differ. Benchmark hashes are joined with document
hashes; each hit names a benchmark item and a diagonal, along which the words
are compared and the longest run is taken: any stretch with at least 80 % equal
words. A document is contaminated where a run has ``MIN_RUN`` words (of 13
words, two may differ anywhere), or the whole of a shorter item (8 and 9 words:
one may differ, 10 to 12: two, fewer than 8: none).
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

from reelhouse.llm.common import GOLDEN, golden, materialize, mix64
from reelhouse.llm.words import word_hashes

#: Every run of ``MIN_RUN`` or more words has a hit of one of these (tests try all cases); the first two do for
#: 13 words with up to two substitutions, the others for longer runs with more.
MASKS = ("11101011", "11001111", "111011", "11110101")
#: The same for items of 8 to 12 words.
SHORT_MASKS = ("1111", "11101")
SPAN = 8
MIN_RUN = 13
#: Benchmark words up to which the benchmark is broadcast (8 bytes each, and 4 seeds of 24); the seeds of a larger
#: one are a table that is joined with the documents' seeds, and nothing of it comes to the driver.
BROADCAST_WORDS = 1 << 19
_FILTER = 20
#: Seeds of a batch.
_ROWS = 1 << 16


def _weights(n: int) -> np.ndarray:
    return mix64((np.arange(n, dtype=np.uint64) + np.uint64(77)) * GOLDEN) | np.uint64(1)


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Masked hash of every window of a word sequence."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    weights = _weights(len(mask))
    out = np.zeros(n, np.uint64)
    for p, bit in enumerate(mask):
        if bit == "1":
            out += hashes[p:p + n] * weights[p]
    return mix64(out + golden((int(mask, 2) << 6) + len(mask)))


def masks_of(n: int) -> tuple[str, ...]:
    """Masks of an item of n words."""
    return MASKS if n >= MIN_RUN else SHORT_MASKS if n >= SPAN else ("1" * n,) if n else ()


def longest_run(words: np.ndarray, hashes: np.ndarray, first: int, last: int, start: int) -> int:
    """Equal words of the longest run on a diagonal, 0 if there is none; the
    document has the words first..last-1, the item would begin at start."""
    a, b = max(start, first), min(start + len(words), last)
    need = min(MIN_RUN, len(words))
    if b - a < need:
        return 0
    equal = hashes[a:b] == words[a - start:b - start]
    if equal.all():
        return len(equal)
    if len(words) < SPAN:
        return 0
    # at least 80 % equal: +1 for an equal word, -4 for another, and the sum is not negative
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -4))])
    begin = np.searchsorted(-np.minimum.accumulate(total), -total, "left")
    length = np.arange(len(total)) - begin
    if length.max() < need:
        return 0
    count = np.concatenate([[0], np.cumsum(equal)])
    return int((count - count[begin])[length == length.max()].max())


class Items:
    """Word hashes and seeds of some benchmark items."""

    def __init__(self, ids: list[int], words: list[np.ndarray]):
        self.ids, self.words = ids, words
        tables: dict[str, list[tuple[np.ndarray, int]]] = {m: [] for m in MASKS}
        for k, w in enumerate(words):
            for mask in masks_of(len(w)):
                tables.setdefault(mask, []).append((seeds(w, mask), k))
        self.tables = {}
        for mask, parts in tables.items():
            if not parts:
                continue
            hashes = np.concatenate([s for s, _ in parts])
            order = np.argsort(hashes, kind="stable")
            item = np.concatenate([np.full(len(s), k) for s, k in parts])[order]
            place = np.concatenate([np.arange(len(s)) for s, _ in parts])[order]
            seen = np.zeros(1 << _FILTER, bool)
            seen[hashes >> np.uint64(64 - _FILTER)] = True
            self.tables[mask] = hashes[order], item, place, seen

    def hits(self, rows: np.ndarray, hashes: np.ndarray) -> set[tuple[int, int, int]]:
        """(row, item, place in ``hashes`` where the item would begin)."""
        found: set[tuple[int, int, int]] = set()
        for mask, (known, item, place, seen) in self.tables.items():
            s = seeds(hashes, mask)
            at = np.flatnonzero(seen[s >> np.uint64(64 - _FILTER)])
            at = at[rows[at] == rows[at + len(mask) - 1]]
            lo, hi = np.searchsorted(known, s[at], "left"), np.searchsorted(known, s[at], "right")
            for w in np.flatnonzero(hi > lo).tolist():
                i = int(at[w])
                found.update((int(rows[i]), int(item[k]), i - int(place[k])) for k in range(lo[w], hi[w]))
        return found

    def run(self, hashes: np.ndarray, first: int, last: int, item: int, start: int) -> int:
        """``longest_run`` of an item."""
        return longest_run(self.words[item], hashes, first, last, start)


def is_short(item_words: int, doc_words: int) -> bool:
    """Whether a match says little: an item under ``SPAN`` words that is not the whole text."""
    return item_words < SPAN and item_words != doc_words


def _find(items):
    def run(batches):
        known: Items = items.value
        for batch in batches:
            got: list[list[tuple[int, int, bool]]] = [[] for _ in range(batch.num_rows)]
            for lo, n, rows, hashes in word_hashes(batch.column("_llm_text")):
                hits = known.hits(rows, hashes)
                for row, item, start in hits:
                    first, last = np.searchsorted(rows, [row, row + 1])
                    equal = known.run(hashes, int(first), int(last), item, start)
                    if equal:
                        got[lo + row].append((item, equal, is_short(len(known.words[item]), int(last - first))))
            best = [max((e for _, e, _ in x), default=0) for x in got]
            named, short = ([sorted({known.ids[k] for k, _, s in x if known.ids[k] is not None and (s or not only)})
                             for x in got] for only in (False, True))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in batch.schema.names if c != "_llm_text"],
                 pa.array([bool(x) for x in got]), pa.array(named, pa.list_(pa.int64())), pa.array(best, pa.int64()),
                 pa.array(short, pa.list_(pa.int64())), pa.array([any(not s for *_, s in x) for x in got], pa.bool_())],
                names=[*[c for c in batch.schema.names if c != "_llm_text"], "_llm_hit", "_llm_items", "_llm_words",
                       "_llm_short", "_llm_long"])
    return run


def _hash_items(batches):
    for batch in batches:
        out = [b""] * batch.num_rows
        for lo, n, rows, hashes in word_hashes(batch.column("_llm_text")):
            ends = np.searchsorted(rows, np.arange(n + 1))
            for r in range(n):
                out[lo + r] = hashes[ends[r]:ends[r + 1]].tobytes()
        yield pa.RecordBatch.from_arrays([batch.column("_llm_id"), pa.array(out, pa.binary())],
                                         names=["_llm_id", "_llm_words"])


def _seed_rows(masks_for):
    """(hash, o, place, n) of all seeds of rows (o, n, words); n is their number of words."""
    def run(batches):
        for batch in batches:
            for o, n, raw in zip(batch.column("o").to_pylist(), batch.column("n").to_pylist(),
                                 batch.column("words").to_pylist(), strict=True):
                words = np.frombuffer(raw, np.uint64)
                for mask in masks_for(n):
                    s = seeds(words, mask)
                    for at in range(0, len(s), _ROWS):
                        part = s[at:at + _ROWS].view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(part), pa.array(np.full(len(part), o)), pa.array(np.arange(at, at + len(part))),
                             pa.array(np.full(len(part), n))], names=["h", "o", "place", "n"])
    return run


def _cut(batches):
    """The words of a document that lie on each diagonal."""
    for batch in batches:
        for o, n, raw, hits in zip(*[batch.column(c).to_pylist() for c in ("o", "n", "words", "hits")], strict=True):
            words = np.frombuffer(raw, np.uint64)
            for at in range(0, len(hits), 256):
                part = hits[at:at + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o] * len(part), pa.int64()), pa.array([n] * len(part), pa.int64()),
                     pa.array([x["item"] for x in part], pa.int64()),
                     pa.array([min(x["start"], 0) for x in part], pa.int64()),
                     pa.array([words[max(x["start"], 0):max(x["start"] + x["n"], 0)].tobytes() for x in part],
                              pa.binary())], names=["o", "n", "item", "start", "part"])


def _verify(batches):
    for batch in batches:
        got = []
        for o, n, start, part, ident, words in zip(
                *[batch.column(c).to_pylist() for c in ("o", "n", "start", "part", "id", "words")], strict=True):
            part, words = np.frombuffer(part, np.uint64), np.frombuffer(words, np.uint64)
            equal = longest_run(words, part, 0, len(part), start)
            if equal:
                got.append((o, ident, equal, is_short(len(words), n)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in got], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.bool_()))],
            names=["o", "id", "equal", "short"])


def _hashed(frame: DataFrame) -> DataFrame:
    return frame.mapInArrow(_hash_items, "_llm_id long, _llm_words binary").where(F.octet_length("_llm_words") > 0)


def _join(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` (with ``_llm_text``) with the verdict columns, by a join of the seeds."""
    number = F.monotonically_increasing_id()
    n_words = (F.octet_length("_llm_words") / 8).cast("long")
    # numbers stay what they are once they are written
    docs = materialize(docs.withColumn("_llm_o", number), "decontam-docs")
    items = materialize(items.select(F.col("_llm_id").alias("id"), F.col("_llm_words").alias("words"),
                                     n_words.alias("n"), number.alias("o")), "decontam-items")
    words = _hashed(docs.select(F.col("_llm_o").alias("_llm_id"), "_llm_text")).select(
        F.col("_llm_id").alias("o"), F.col("_llm_words").alias("words"), n_words.alias("n"))
    kinds = [r[0] for r in items.select(F.least("n", F.lit(MIN_RUN))).distinct().collect()]    # MIN_RUN at most
    masks = sorted({m for k in kinds for m in masks_of(k)})
    schema = "h long, o long, place long, n long"
    known = items.select("o", "n", "words").mapInArrow(_seed_rows(masks_of), schema).select(
        "h", F.col("o").alias("item"), F.col("place").alias("at"), F.col("n").alias("size"))
    hits = (words.mapInArrow(_seed_rows(lambda n: masks), schema).join(known, "h")
            .select("o", "item", (F.col("place") - F.col("at")).alias("start"), "size").distinct()
            .groupBy("o").agg(F.collect_list(F.struct("item", "start", F.col("size").alias("n"))).alias("hits")))
    cut = words.join(hits, "o").mapInArrow(_cut, "o long, n long, item long, start long, part binary")
    pairs = cut.join(items.select(F.col("o").alias("item"), "id", F.col("words")), "item")
    found = (pairs.mapInArrow(_verify, "o long, id long, equal long, short boolean").groupBy(F.col("o").alias("_llm_o"))
             .agg(F.sort_array(F.collect_set("id")).alias("_llm_items"), F.max("equal").alias("_llm_words"),
                  F.sort_array(F.collect_set(F.when(F.col("short"), F.col("id")))).alias("_llm_short"),
                  F.bool_or(~F.col("short")).alias("_llm_long")))
    none = F.array().cast("array<bigint>")
    return docs.join(found, "_llm_o", "left").withColumns({
        "_llm_hit": F.col("_llm_words").isNotNull(), "_llm_items": F.coalesce("_llm_items", none),
        "_llm_words": F.coalesce("_llm_words", F.lit(0).cast("long")), "_llm_short": F.coalesce("_llm_short", none),
        "_llm_long": F.coalesce("_llm_long", F.lit(False))})


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``contaminated``, ``item_ids`` (sorted),
    ``longest_match`` (equal words of the longest run), ``short_item_ids`` (those
    of fewer than eight words that match inside a longer text) and
    ``only_short`` (contaminated by nothing but such items).

    Words are split at ``[\\x20\\x09-\\x0D]`` with A-Z lowered. Items with fewer
    than eight words match where their whole sequence occurs. Null and empty
    texts and items match nothing; items without an id match, but are not
    listed. Every row gives one row; empty tables give an empty table or no
    match. Input columns of these names are replaced."""
    names = {"contaminated", "item_ids", "longest_match", "short_item_ids", "only_short"}
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c.lower() not in names]
    slim = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("_llm_text"))
    items = _hashed(benchmark.select(F.col(item_id).cast("long").alias("_llm_id"),
                                     F.col(item_text).alias("_llm_text")))
    words = (items.agg(F.sum(F.octet_length("_llm_words").cast("long"))).first()[0] or 0) // 8
    if words > BROADCAST_WORDS:
        out = _join(slim, items)
    else:
        got = [(r[0], np.frombuffer(bytes(r[1]), np.uint64)) for r in items.toLocalIterator()]
        known = spark.sparkContext.broadcast(Items([i for i, _ in got], [w for _, w in got]))
        out = slim.mapInArrow(_find(known), StructType([
            *[f for f in slim.schema.fields if f.name != "_llm_text"], StructField("_llm_hit", BooleanType()),
            StructField("_llm_items", ArrayType(LongType())), StructField("_llm_words", LongType()),
            StructField("_llm_short", ArrayType(LongType())), StructField("_llm_long", BooleanType())]))
    return out.select(*[F.col(f"`{c}`") for c in keep], F.col("_llm_hit").alias("contaminated"),
                      F.col("_llm_items").alias("item_ids"), F.col("_llm_words").alias("longest_match"),
                      F.col("_llm_short").alias("short_item_ids"),
                      (F.col("_llm_hit") & ~F.col("_llm_long")).alias("only_short"))
