"""Line dedup by a sharded minimal perfect hash.

Lines become 128-bit hashes. The distinct hashes of a shard are numbered
0..n-1 without gaps by a minimal perfect hash (levels of bit arrays; a key
that is alone at its place on a level is settled there, its number is the
rank of its bit). That number indexes compact arrays: a 32-bit fingerprint,
the number of documents, the largest doc_id. Documents are put in buckets; a
bucket asks each shard once per distinct line, reads the arrays by number, and
gets back only the lines to drop. No line text is shuffled or joined, and a
line that a third of all documents hold costs one row per bucket.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from reelhouse.llm.common import (SPACES, bucket_of, buckets_for, golden, materialize, mix64, texts,
                                  volume, with_columns)

#: Documents per index shard (each has some lines: tens of thousands of keys).
DOCS_PER_SHARD = 512
_NONE = -(1 << 63)

POSTINGS = "_llm_shard int, _llm_h1 long, _llm_h2 long, _llm_bucket int, _llm_n long, _llm_max long"
INDEX = "_llm_shard int, n_keys int, levels binary, fingerprints binary, counts binary, holders binary"
DROPS = "_llm_bucket int, _llm_h1 long, _llm_h2 long, _llm_keep long"


class MinimalPerfectHash:
    """Numbers of distinct 128-bit keys, 0..n-1."""

    def __init__(self, sizes: list[int], bits: list[np.ndarray]):
        self.sizes, self.bits = sizes, bits
        self.before, total = [], 0
        for b in bits:
            ones = np.unpackbits(b)
            self.before.append(np.cumsum(ones, dtype=np.int64) - ones + total)
            total += int(ones.sum())
        self.n = total

    @staticmethod
    def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        x = mix64(h1 ^ mix64(h2 + golden(level + 1)))
        return (x % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> "MinimalPerfectHash":
        sizes, bits, level = [], [], 0
        while len(h1):
            size = -(-max(len(h1), 8) // 8) * 8
            at = cls._place(h1, h2, level, size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone))
            rest = ~alone[at]
            h1, h2, level = h1[rest], h2[rest], level + 1
        return cls(sizes, bits)

    def number(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Number of each key; -1 where no level has its bit."""
        out = np.full(len(h1), -1, np.int64)
        open_ = np.arange(len(h1))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = self._place(h1[open_], h2[open_], level, size)
            hit = (self.bits[level][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            out[open_[hit]] = self.before[level][at[hit]]
            open_ = open_[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), *self.sizes], np.int64).tobytes()
        return head + b"".join(b.tobytes() for b in self.bits)

    @classmethod
    def from_bytes(cls, raw: bytes) -> "MinimalPerfectHash":
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        sizes = np.frombuffer(raw, np.int64, n, 8).tolist()
        bits, at = [], 8 * (n + 1)
        for s in sizes:
            bits.append(np.frombuffer(raw, np.uint8, s // 8, at))
            at += s // 8
        return cls(sizes, bits)


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key, or None if the key is too short."""
    key = line.strip(SPACES).lower()          # bytes.lower: A-Z only
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def _postings(n_shards: int, min_chars: int):
    def run(batches):
        for batch in batches:
            held: dict[tuple[int, bytes], list[int]] = {}
            ids = batch.column("_llm_id").to_pylist()
            for b, i, text in zip(batch.column("_llm_bucket").to_pylist(), ids, texts(batch.column("_llm_text")),
                                  strict=True):
                i = _NONE if i is None else i
                for key in {line_key(x, min_chars) for x in text.split(b"\n")} - {None}:
                    got = held.get((b, key))
                    if got is None:
                        held[b, key] = [1, i]
                    else:
                        got[0] += 1
                        got[1] = max(got[1], i)
            h = np.frombuffer(b"".join(k for _, k in held), np.int64).reshape(-1, 2)
            h1, h2 = np.ascontiguousarray(h[:, 0]), np.ascontiguousarray(h[:, 1])
            yield pa.RecordBatch.from_arrays([
                pa.array((h1.view(np.uint64) % np.uint64(n_shards)).astype(np.int32)), pa.array(h1), pa.array(h2),
                pa.array([b for b, _ in held], pa.int32()), pa.array([v[0] for v in held.values()], pa.int64()),
                pa.array([v[1] for v in held.values()], pa.int64())],
                names=["_llm_shard", "_llm_h1", "_llm_h2", "_llm_bucket", "_llm_n", "_llm_max"])
    return run


def _keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return (table.column("_llm_h1").to_numpy().view(np.uint64), table.column("_llm_h2").to_numpy().view(np.uint64))


def _build(table: pa.Table) -> pa.Table:
    h1, h2 = _keys(table)
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    mph = MinimalPerfectHash.build(a[new], b[new])
    at = mph.number(h1, h2)
    counts, holders = np.zeros(mph.n, np.int64), np.full(mph.n, _NONE, np.int64)
    np.add.at(counts, at, table.column("_llm_n").to_numpy())
    np.maximum.at(holders, at, table.column("_llm_max").to_numpy())
    prints = np.zeros(mph.n, np.uint32)
    prints[at] = h2.astype(np.uint32)
    # a count of 2^32 - 1 stands for that many or more
    return pa.table({"_llm_shard": pa.array([table.column("_llm_shard")[0].as_py()], pa.int32()),
                     "n_keys": pa.array([mph.n], pa.int32()), "levels": [mph.to_bytes()],
                     "fingerprints": [prints.tobytes()],
                     "counts": [np.minimum(counts, 0xFFFFFFFF).astype(np.uint32).tobytes()],
                     "holders": [holders.tobytes()]})


def _probe(min_docs: int):
    def run(asked: pa.Table, index: pa.Table) -> pa.Table:
        if not index.num_rows or not asked.num_rows:
            keep = np.zeros(0, np.int64)
            asked, drop = asked.slice(0, 0), np.zeros(0, bool)
        else:
            row = index.slice(0, 1).to_pylist()[0]
            mph = MinimalPerfectHash.from_bytes(row["levels"])
            h1, h2 = _keys(asked)
            at = mph.number(h1, h2)
            known = at >= 0
            known[known] = np.frombuffer(row["fingerprints"], np.uint32)[at[known]] == h2[known].astype(np.uint32)
            drop = known.copy()
            drop[known] = np.frombuffer(row["counts"], np.uint32)[at[known]] >= min_docs
            keep = np.frombuffer(row["holders"], np.int64)[at[drop]]
        asked = asked.filter(pa.array(drop))
        return pa.table({"_llm_bucket": asked.column("_llm_bucket"), "_llm_h1": asked.column("_llm_h1"),
                         "_llm_h2": asked.column("_llm_h2"), "_llm_keep": pa.array(keep)})
    return run


def _rewrite(id_col: str, text_col: str, min_chars: int, names: list[str]):
    def run(docs: pa.Table, drops: pa.Table) -> pa.Table:
        keys = np.stack([drops.column("_llm_h1").to_numpy(), drops.column("_llm_h2").to_numpy()], 1)
        raw = np.ascontiguousarray(keys).tobytes()
        keep = {raw[16 * i:16 * i + 16]: k for i, k in enumerate(drops.column("_llm_keep").to_pylist())}
        out, n_lines, n_dropped = [], [], []
        for i, text in zip(docs.column(id_col).to_pylist(), texts(docs.column(text_col)), strict=True):
            i = _NONE if i is None else i
            lines = text.split(b"\n")
            kept = [x for x in lines if keep.get(line_key(x, min_chars), i) == i] if keep else lines
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
            out.append(b"\n".join(kept) if len(kept) < len(lines) else text)
        made = {text_col: pa.array(out, pa.binary()).cast(pa.string()), "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64())}
        return pa.table([made[n] if n in made else docs.column(n) for n in names], names=names)
    return run


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
               min_docs: int = 3) -> DataFrame:
    """All columns of ``docs`` with the text without its dropped lines, plus
    ``n_lines`` (before dropping) and ``n_dropped``.

    A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lowered.
    A key of ``min_chars`` code points or more that ``min_docs`` rows or more
    hold loses all its lines but those of the largest id that holds it.

    Null text: one empty line, text becomes empty. Null ids sort below all
    others. Rows that repeat an id are documents of their own when counting,
    and all keep the line if that id is the largest. An empty table gives an
    empty table. Input columns named n_lines or n_dropped are replaced; names
    that start with ``_llm_`` are reserved."""
    n_docs, n_bytes = volume(docs, text_col)
    n_shards, n_buckets = max(1, -(-n_docs // DOCS_PER_SHARD)), buckets_for(n_bytes)
    bucket = bucket_of(id_col, text_col, n_buckets)
    slim = docs.select(bucket.alias("_llm_bucket"), F.col(id_col).cast("long").alias("_llm_id"),
                       F.col(text_col).alias("_llm_text"))
    keys = ["_llm_shard", "_llm_h1", "_llm_h2", "_llm_bucket"]
    postings = materialize(
        slim.mapInArrow(_postings(n_shards, min_chars), POSTINGS).groupBy(*keys)
        .agg(F.sum("_llm_n").alias("_llm_n"), F.max("_llm_max").alias("_llm_max")), "line-postings")
    index = materialize(postings.groupBy("_llm_shard").applyInArrow(_build, INDEX), "line-index")
    drops = postings.groupBy("_llm_shard").cogroup(index.groupBy("_llm_shard")).applyInArrow(_probe(min_docs), DROPS)
    schema = with_columns(docs.schema, n_lines=LongType(), n_dropped=LongType())
    rows = docs.select(*[F.col(f"`{f.name}`") for f in schema.fields if f.name in docs.columns],
                       bucket.alias("_llm_bucket"))
    return rows.groupBy("_llm_bucket").cogroup(drops.groupBy("_llm_bucket")).applyInArrow(
        _rewrite(id_col, text_col, min_chars, schema.names), schema)
