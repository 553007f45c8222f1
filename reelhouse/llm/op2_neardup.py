"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

Equal shingle sets are one class, its smallest id stands for it. Each set gets
a SuperMinHash signature: element after element of a random permutation of the
slots, with rank j + r for the j-th slot, so that the slots of one element are
correlated and a set is done as soon as every slot holds less than the next
rank. Bands of slots give buckets. In a bucket, members are compared on their
full sets with the smallest member first; links are joined by union-find. The
members of buckets that still hold several groups are paired by an exact rule
(their rarest shingles must have one in common), verified and joined too, so
that no link between members of buckets is lost. Pairs of one group, of too
different size, with too little left after their first common shingle, or whose
bitmaps differ too much are never listed. A shingle with more than ``OPEN``
members takes its smallest member as centre first; what then still is in
several groups is paired once, in pieces of ``OPEN`` members of similar size, so
that the number of rounds does not grow with the members.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import golden, materialize, mix64
from reelhouse.llm.components import components
from reelhouse.llm.words import shingles, word_hashes

#: 40 bands of 5 slots: a pair of similarity 0.8 shares no bucket with probability (1 - 0.8^5)^40 = 1.3e-7.
BANDS, ROWS = 40, 5
SLOTS = BANDS * ROWS
#: Members of a shingle up to which their pairs are tested at once; beyond, in pieces of so many.
OPEN = 4096
#: 64-bit words of the bitmap of a set.
WORDS = 4
#: Shingles whose counts are sent to the tasks at most (16 bytes each).
COMMON = 1 << 19
#: Rows of the id list that may be broadcast (24 bytes each); longer lists are joined by shuffle.
BROADCAST_IDS = 500_000
#: Elements handled at once (SLOTS bytes each).
CHUNK = 100_000

_PREFIX = ["key", "rep", "n", "pos", "p1", "p2", "p3", *[f"m{w}" for w in range(WORDS)]]
_LOW = np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)


def signatures(sets: list[np.ndarray], m: int = SLOTS) -> np.ndarray:
    """SuperMinHash of non-empty sets: rank j in the upper, random part in the
    lower 32 bits of each slot."""
    out = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    at = 0
    while at < len(sets):
        stop, size = at, 0
        while stop < len(sets) and (stop == at or size + len(sets[stop]) <= CHUNK):
            size += len(sets[stop])
            stop += 1
        _sign(sets[at:stop], out[at:stop], m)
        at = stop
    return out


def _sign(sets: list[np.ndarray], out: np.ndarray, m: int) -> None:
    items = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = None                              # permutation of the slots of each element that is still needed
    swap = None
    flat = out.reshape(-1)
    for j in range(m):
        x = mix64(items + golden(j + 1))
        value = (x >> _32) + np.uint64(j << 32)
        k = (((x & _LOW) * np.uint64(m - j)) >> _32).astype(np.int64) + j
        if j == 0:
            slot, swap = k, k
        else:
            if order is None:
                order = np.broadcast_to(np.arange(m, dtype=np.uint8), (len(items), m)).copy()
                order[np.arange(len(items)), swap] = 0
                order[:, 0] = swap
            i = np.arange(len(items))
            slot = order[i, k].astype(np.int64)
            order[i, k] = order[:, j]
        np.minimum.at(flat, rows * m + slot, value)
        done = out.max(1) < np.uint64((j + 1) << 32)
        if done.all():
            return
        stay = ~done[rows]
        if j == 0 or stay.mean() < 0.75:
            items, rows = items[stay], rows[stay]
            swap = swap[stay] if order is None else swap
            order = order[stay] if order is not None else None


def bands(signature: np.ndarray) -> np.ndarray:
    """Bucket keys of signatures (one row each)."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    out = np.zeros((len(signature), BANDS), np.uint64) + mix64(np.arange(BANDS, dtype=np.uint64) + golden(3))
    for r in range(ROWS):
        out = mix64(out ^ mix64(parts[:, :, r] + golden(r + 1)))
    return out


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _describe(k: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("_llm_id")
            for lo, n, rows, hashes in word_hashes(batch.column("_llm_text")):
                sets = shingles(rows, hashes, n, k)
                full = [i for i in range(n) if len(sets[i])]
                keys = bands(signatures([sets[i] for i in full])).view(np.int64) if full else np.zeros((0, BANDS), np.int64)
                digests = np.frombuffer(b"".join(_digest(s) for s in sets), np.int64).reshape(-1, 2)
                offsets = np.zeros(n + 1, np.int32)
                offsets[1:] = np.cumsum([BANDS if len(s) else 0 for s in sets])
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, n), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0].copy()),
                    pa.array(digests[:, 1].copy()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))],
                    names=["id", "n", "d1", "d2", "keys"])
    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            rep, d1, d2 = (batch.column(c).to_numpy() for c in ("_llm_id", "d1", "d2"))
            for lo, n, rows, hashes in word_hashes(batch.column("_llm_text")):
                sets = shingles(rows, hashes, n, k)
                right = [i for i in range(n)
                         if _digest(sets[i]) == np.array([d1[lo + i], d2[lo + i]], np.int64).tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[[lo + i for i in right]], pa.int64()),
                     pa.array([sets[i].tobytes() for i in right], pa.binary())], names=["rep", "items"])
    return run


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(key, rep, n, pos, p1, p2, p3, m0...; p are the shingles before, m the bitmap of the set): the shingles of each set that any set of enough
    similarity must share one of: with all shingles in one fixed order, the
    first n - ceil(percent * n / 100) + 1. Shingles of many sets come last in
    that order, so that a passage that many documents have makes no pairs. The
    counts of at most ``COMMON`` shingles are needed for it (those of at least
    1/COMMON of all occurrences), and only those go through the driver."""
    spark = sets.sparkSession
    total = sets.agg(F.sum("n")).first()[0] or 0
    least = max(8, -(-total // COMMON))
    counts = sets.mapInArrow(_count, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")).where(
        F.col("c") >= least).toArrow().sort_by("key")
    table = spark.sparkContext.broadcast((counts.column("key").to_numpy(), counts.column("c").to_numpy()))
    return sets.mapInArrow(_first(table, percent), ", ".join(f"{c} long" for c in _PREFIX))


def _count(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            items = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("items").slice(at, 1000)]
            key, c = np.unique(np.concatenate(items), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(c)], names=["key", "c"])


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """``WORDS`` words a set (one row each): a bit tells whether an odd number of
    its elements fall on it. Two sets have no fewer different elements than
    their bitmaps have different bits."""
    bit = np.concatenate([np.zeros(0, np.int64), *sets]).view(np.uint64) % np.uint64(64 * WORDS)
    at = np.repeat(np.arange(len(sets)), [len(s) for s in sets]) * (64 * WORDS) + bit.astype(np.int64)
    odd = np.bincount(at, minlength=len(sets) * 64 * WORDS) % 2 == 1
    return np.packbits(odd, bitorder="little").view(np.int64).reshape(len(sets), WORDS)


def _first(table, percent: int):
    def run(batches):
        known, count = table.value
        for batch in batches:
            rep, keys = batch.column("rep").to_pylist(), []
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("items")]
            for x in sets:
                rank = np.zeros(len(x), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
                    rank = np.where(known[at] == x, count[at], 0)
                size = len(x) + (-percent * len(x) // 100) + 1
                keys.append(x[np.lexsort((x, rank))[:size]])
            n = [len(k) for k in keys]
            flat = np.concatenate([np.zeros(0, np.int64), *keys])
            pos = np.concatenate([np.zeros(0, np.int64), *[np.arange(x) for x in n]])
            before = [pa.array(np.concatenate([np.zeros(min(k, len(flat)), np.int64), flat[:-k]]), mask=pos < k)
                      for k in (1, 2, 3)]
            maps = [pa.array(np.repeat(m, n)) for m in np.concatenate([bitmaps(sets[at:at + 1000]) for at in range(0, len(sets), 1000)]
                                                                      or [np.zeros((0, WORDS), np.int64)]).T]
            yield pa.RecordBatch.from_arrays([
                pa.array(flat), pa.array(np.repeat(rep, n).astype(np.int64)),
                pa.array(np.repeat(batch.column("n").to_numpy(), n)), pa.array(pos), *before, *maps],
                names=_PREFIX)
    return run


def _in_pieces(rows: DataFrame, fits, percent: int) -> DataFrame:
    """Pairs (a, b) of rows of one key that ``fits``. Sets that are similar
    enough are of the same or the next class of sizes; a class of a key is cut
    into pieces of about ``OPEN`` rows, each of which meets the smaller sets of
    its and the class before. A piece is all that a task holds at once, and the
    pieces of a key go to different tasks."""
    # a little wider than need be, for rounding
    width = max(math.log(100 / percent), 1e-3) * (1 + 1e-9)
    rows = rows.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / width))
    pieces = rows.groupBy("key", "class").agg(F.ceil(F.count(F.lit(1)) / OPEN).alias("pieces"))
    larger = rows.join(pieces, ["key", "class"]).withColumn("piece", F.pmod(F.xxhash64("rep"), "pieces")).drop("pieces")
    smaller = (rows.withColumn("class", F.explode(F.array("class", F.col("class") + 1))).join(pieces, ["key", "class"])
               .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))).drop("pieces"))
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("key", "class", "piece")]
    order = F.expr("l.n < r.n or (l.n = r.n and l.rep < r.rep)")
    return smaller.alias("l").join(larger.alias("r"), same[0] & same[1] & same[2] & order & fits).select(
        F.least("l.rep", "r.rep").alias("a"), F.greatest("l.rep", "r.rep").alias("b"))


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            hit = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                hit.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(hit, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 80) -> DataFrame:
    """id, ``n_shingles``, ``component_id`` (smallest id reachable over links)
    and ``kept`` (id = component_id) of every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; a row's set is its
    distinct ``k``-word shingles, with fewer words the whole sequence as one.
    Two rows are linked if 100 * intersection >= ``percent`` * union.

    Null and empty texts have an empty set, are linked with nothing and kept.
    Rows with a null id are put in no group: their component_id is null and
    they are kept. Rows that repeat an id are the same document: their links
    are joined and they are kept or dropped together. An empty table gives an
    empty table. Other columns are not read."""
    slim = docs.select(F.col(id_col).cast("long").alias("_llm_id"), F.col(text_col).alias("_llm_text"))
    rows = materialize(slim.mapInArrow(_describe(k), "id long, n long, d1 long, d2 long, keys array<bigint>"),
                       "signatures")
    classes = materialize(rows.where("n > 0 and id is not null").groupBy("d1", "d2").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys")), "classes")
    keys = classes.select("rep", "n", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("top")).where("centre <> top")
    members = materialize(keys.join(shared.select("key", "centre"), "key"), "members")
    involved = members.select("rep").distinct().join(classes.select("rep", "d1", "d2"), "rep")
    involved = materialize(involved, "involved")
    small = involved.count() <= BROADCAST_IDS
    texts = slim.join(F.broadcast(involved) if small else involved, slim["_llm_id"] == involved["rep"]).select(
        "_llm_id", "_llm_text", "d1", "d2")
    sets = materialize(texts.mapInArrow(_sets(k), "rep long, items binary"), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        first = sets.select(F.col("rep").alias("a"), F.col("items").alias("x"))
        second = sets.select(F.col("rep").alias("b"), F.col("items").alias("y"))
        return pairs.join(first, "a").join(second, "b").mapInArrow(_verify(percent), "a long, b long")

    # first the smallest centre of each member: one pair a member
    stars = members.where("rep <> centre").groupBy(F.col("rep").alias("b")).agg(F.min("centre").alias("a"))
    links = materialize(linked(stars.select("a", "b")), "verified")
    tops = components(links)
    # then the members of buckets that still hold several groups, by their rarest shingles
    marked = members.join(tops.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", "n", F.coalesce("top", "rep").alias("top"))
    several = marked.groupBy("key").agg(F.min("top").alias("lo"), F.max("top").alias("hi")).where("lo <> hi")
    waiting = marked.join(several.select("key"), "key", "left_semi").select("rep", "n").distinct()
    waiting = materialize(sets.join(waiting, "rep"), "waiting")
    open_ = materialize(_prefixes(waiting, percent), "prefixes")
    # what is left of both sets from their first common shingle on must be enough
    fits = ((F.least("l.n", "r.n") * 100 >= percent * F.greatest("l.n", "r.n"))
            & (F.least(F.expr("l.n - l.pos"), F.expr("r.n - r.pos")) * (100 + percent)
               >= percent * F.expr("l.n + r.n")) & (F.col("l.top") != F.col("r.top"))
            # and so must be the elements that may be equal by the bitmaps
            & (F.expr(" + ".join(f"bit_count(l.m{w} ^ r.m{w})" for w in range(WORDS))) * (100 + percent)
               <= (100 - percent) * F.expr("l.n + r.n"))
            # a pair with a common shingle just before has been listed there
            & ~F.expr("coalesce(l.p1 = r.p1 or l.p1 = r.p2 or l.p2 = r.p1 or l.p1 = r.p3 or l.p3 = r.p1, false)"))
    for last in (False, True):
        marked = open_.join(tops.withColumnRenamed("node", "rep"), "rep", "left").select(
            *_PREFIX, F.coalesce("top", "rep").alias("top"))
        sizes = marked.groupBy("key", "top").agg(F.count(F.lit(1)).alias("c"))
        need = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("groups"), F.sum("c").alias("c")).where("groups > 1")
        need = need.select("key", (F.col("c") > OPEN).alias("hot"))
        open_ = materialize(marked.join(need, "key"), "open")
        few, many = open_.where("not hot"), open_.where("hot")
        if last:        # the keys that had many members, whatever is left of them
            pairs = _in_pieces(open_, fits, percent)
        else:
            centre = many.groupBy("key").agg(F.min(F.struct("rep", *[c for c in _PREFIX if c not in ("key", "rep")], "top"))
                                             .alias("c")).select("key", "c.*")
            rest = many.alias("r").join(centre.alias("l"), (F.col("l.key") == F.col("r.key"))
                                        & (F.col("l.rep") < F.col("r.rep")))
            pairs = few.alias("l").join(few.alias("r"), (F.col("l.key") == F.col("r.key"))
                                        & (F.col("l.rep") < F.col("r.rep")) & fits).select(
                F.col("l.rep").alias("a"), F.col("r.rep").alias("b"))
            pairs = pairs.unionByName(rest.where(fits).select(F.col("l.rep").alias("a"), F.col("r.rep").alias("b")))
        pairs = materialize(pairs.distinct(), "pairs")
        if pairs.take(1):
            more = materialize(linked(pairs), "verified")
            if more.take(1):
                links = links.unionByName(more)
                tops = components(links)
        if last or not many.take(1):
            break
        open_ = materialize(rest.select(*[f"r.{c}" for c in _PREFIX]), "rest")
    named = classes.join(tops, classes["rep"] == tops["node"], "left").select(
        "d1", "d2", F.coalesce("top", "rep").alias("component"))
    whole = rows.select("id", "n", F.when(F.expr("n > 0 and id is not null"), F.col("d1")).alias("d1"), "d2")
    out = whole.join(named, ["d1", "d2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
