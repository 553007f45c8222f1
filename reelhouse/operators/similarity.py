"""Exact cosine similarity between binary user-item rows, all pairs or the best.

All pairs with a common item go through the items' user lists: each list, cut
into chunks of ``CHUNK_USERS``, is sent to its users, where common items are
counted per pair. Work and shuffle grow with the pairs of users of an item, not
with the square of all users; a row holds one chunk, its ids in few bits a
byte, and goes to the smaller user of a pair only. A task counts the rows of
some users at a time, so that nothing spills but the sort of the rows. A hot
item's pairs are spread over its users and chunks.

The best ``k`` of each block pair (``top_k``) are found by blocks: users are
hashed into as many blocks as give
``BLOCK_USERS`` users each; Spark shuffles each user's item list (one row a
user) to the block pairs it belongs to, and one grouped-map task per block
pair multiplies the two incidence matrices with numpy, ``ITEM_SLICE`` items
at a time. A task's matrices take about 2 * 4 * BLOCK_USERS * ITEM_SLICE bytes
for the slices and 30 * BLOCK_USERS^2 bytes for the scores (190 MB as set),
whatever the number of users and titles; beside them are the item lists of
two blocks. The global top k is inside the union, so the shuffle after the
grouped map carries at most k x blocks rows per user.

Left and right inputs may differ (e.g. users' training rows against
everyone's full rows); a user is never paired with itself.
"""
from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .packed import pack_steps, unpack_steps
from .stored import store

CHUNK_USERS = 1024
#: Users of lists that a task unpacks and counts at once.
ENTRIES = 1 << 19
BLOCK_USERS = 2048
ITEM_SLICE = 4096

PAIR_SCHEMA = T.StructType([
    T.StructField("user_1", T.StringType()), T.StructField("user_2", T.StringType()),
    T.StructField("shared", T.LongType()), T.StructField("n_1", T.LongType()),
    T.StructField("n_2", T.LongType()), T.StructField("similarity", T.DoubleType()),
])


def _users(df: DataFrame) -> DataFrame:
    """One row a user with the list of distinct items (the catalogue bounds it)."""
    return df.groupBy("user_id").agg(F.collect_set("content_id").alias("items"))


def _block_pair_rows(users: DataFrame, blocks: Column, side: str) -> DataFrame:
    """Copy each user to every block pair holding its block."""
    b = F.pmod(F.xxhash64("user_id"), blocks).cast("int")
    return (users.select("user_id", "items", b.alias("_b"),
                         F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))).alias("_o"))
            .select(F.least("_b", "_o").alias("_lo"), F.greatest("_b", "_o").alias("_hi"),
                    "_b", "user_id", "items", F.lit(side).alias("_side")))


def _shared_items(left: pd.Series, right: pd.Series) -> np.ndarray:
    """Number of common items of each left and right list, slice by slice."""
    sizes = [left.map(len).to_numpy(), right.map(len).to_numpy()]
    code, _ = pd.factorize(np.concatenate([*left, *right]))
    cut = int(sizes[0].sum())
    codes = code[:cut], code[cut:]
    rows = [np.repeat(np.arange(len(n)), n) for n in sizes]
    shared = np.zeros((len(left), len(right)), dtype=np.float32)      # exact: counts below 2^24
    for start in range(0, int(code.max()) + 1 if len(code) else 0, ITEM_SLICE):
        part = []
        for r, c, n in zip(rows, codes, sizes):
            here = (c >= start) & (c < start + ITEM_SLICE)
            m = np.zeros((len(n), ITEM_SLICE), dtype=np.float32)
            m[r[here], c[here] - start] = 1.0
            part.append(m)
        shared += part[0] @ part[1].T
    return shared


def _pair_scores(pdf: pd.DataFrame, top_k: int) -> pd.DataFrame:
    left = pdf[pdf["_side"] == "L"]
    right = pdf[pdf["_side"] == "R"]
    lo, hi = int(pdf["_lo"].iloc[0]), int(pdf["_hi"].iloc[0])
    out = []
    # the left users of block lo meet right users of block hi, and vice versa
    combos = [(lo, hi)] if lo == hi else [(lo, hi), (hi, lo)]
    for lb, rb in combos:
        L = left[left["_b"] == lb]
        R = right[right["_b"] == rb]
        if L.empty or R.empty:
            continue
        shared = _shared_items(L["items"], R["items"])
        n1 = L["items"].map(len).to_numpy(dtype=np.float64)
        n2 = R["items"].map(len).to_numpy(dtype=np.float64)
        # fixed-width unicode arrays: vectorised comparisons in code-point
        # (= byte) order, like Spark's string ordering for these ids
        lu_arr = np.asarray(L["user_id"].to_numpy(), dtype=str)
        ru_arr = np.asarray(R["user_id"].to_numpy(), dtype=str)
        mask = shared > 0
        mask &= lu_arr[:, None] != ru_arr[None, :]
        sim_all = np.where(mask, shared / np.sqrt(n1[:, None] * n2[None, :]), -1.0)
        if sim_all.shape[1] > top_k:
            # keep, per left user, every right user scoring at least its k-th
            # best value (all ties at the cut survive; the exact tie-break by
            # id happens below on this short list)
            kth = -np.partition(-sim_all, top_k - 1, axis=1)[:, top_k - 1]
            mask &= sim_all >= kth[:, None]
        ii, jj = np.nonzero(mask)
        if len(ii) == 0:
            continue
        s = shared[ii, jj]
        part = pd.DataFrame({"user_1": lu_arr[ii], "user_2": ru_arr[jj], "shared": s.astype(np.int64),
                             "n_1": n1[ii].astype(np.int64), "n_2": n2[jj].astype(np.int64),
                             "similarity": sim_all[ii, jj]})
        part = part.sort_values(["user_1", "similarity", "user_2"], ascending=[True, False, True])
        part = part.groupby("user_1", sort=False).head(top_k)
        out.append(part)
    if not out:
        return pd.DataFrame({f.name: pd.Series(dtype=o) for f, o in
                             zip(PAIR_SCHEMA.fields, ["object", "object", "int64", "int64", "int64", "float64"])})
    return pd.concat(out, ignore_index=True)


def _rows(df: DataFrame) -> DataFrame:
    """Distinct (user_id, n, content_id), n the user's number of items, stored with a row a user."""
    # a NULL id is the user "None", as in the blocks
    sets = df.where(F.col("content_id").isNotNull()).groupBy(F.coalesce("user_id", F.lit("None")).alias("user_id")).agg(
        F.collect_set("content_id").alias("items"))
    stored = store(sets, "user-items")
    return stored.select("user_id", F.size("items").alias("n"), F.explode("items").alias("content_id"))


def _chunks(rows: DataFrame) -> DataFrame:
    """content_id, _chunks (their number), users: the sorted users (user_id, n) of an item in chunks of about ``CHUNK_USERS``."""
    many = rows.groupBy("content_id").agg(F.ceil(F.count(F.lit(1)) / CHUNK_USERS).cast("int").alias("_chunks")).where("_chunks > 1")
    many = store(many, "hot-items")
    if many.isEmpty():
        rows, keys = rows.withColumn("_chunks", F.lit(1)), ["content_id", "_chunks"]
    else:
        rows = rows.join(many, "content_id", "left").fillna(1, ["_chunks"])
        rows, keys = rows.withColumn("_chunk", F.pmod(F.xxhash64("user_id"), F.col("_chunks"))), ["content_id", "_chunks", "_chunk"]
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("user_id", "n"))).alias("users")).select(
        "content_id", "_chunks", "users")


def _names(users: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of (user_id, n): offsets of the lists, n, offsets of the ids and their bytes, and the ids."""
    flat = users.flatten()
    name = flat.field("user_id").cast(pa.large_binary())
    at = np.frombuffer(name.buffers()[1], np.int64)[name.offset:name.offset + len(name) + 1] if len(name) else np.zeros(1, np.int64)
    data = np.frombuffer(name.buffers()[2], np.uint8) if len(name) and name.buffers()[2] else np.zeros(0, np.uint8)
    offsets = users.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], flat.field("n").to_numpy(zero_copy_only=False).astype(np.int64), at, data, flat.field("user_id")


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], ..., start[0] + size[0] - 1, start[1], ..."""
    end = np.cumsum(size)
    return np.repeat(start - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)


def _dealt(both: bool):
    """Of rows (mine, others): for each user of ``mine`` the ``others`` after it (all but itself if ``both``), as three packed
    lists: lengths of the ids, numbers of items, and the ids' bytes less ``base``."""
    def run(batches):
        for whole in batches:
            lists = whole.column("mine"), whole.column("others")
            work = np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) * lists[1].value_lengths().to_numpy(zero_copy_only=False))
            i = 0
            while i < len(whole):
                j = max(i + 1, int(np.searchsorted(work, (work[i - 1] if i else 0) + ENTRIES, "right")))
                yield from rows(*(c.slice(i, j - i) for c in lists))
                i = j

    def rows(mine, others):
        off, n, _, _, me = _names(mine)
        o_off, o_n, at, data, name = _names(others)
        times = np.diff(off)
        lo, hi = (np.repeat(x, times) for x in (o_off[:-1], o_off[1:]))
        # the others up to the user itself (or the place it would have): ids are sorted by their bytes
        key = [x.cast(pa.binary()).to_pylist() for x in (me, name)]
        row = np.repeat(np.arange(len(times)), times)
        cut = np.array([bisect.bisect_right(key[1], u, int(o_off[r]), int(o_off[r + 1])) for u, r in zip(key[0], row, strict=True)], np.int64)
        for k in (0, 1) if both else (1,):
            start, stop = (cut, hi) if k else (lo, np.array([bisect.bisect_left(key[1], u, int(o_off[r]), int(o_off[r + 1]))
                                                             for u, r in zip(key[0], row, strict=True)], np.int64))
            some = np.flatnonzero(stop > start)
            if not len(some):
                continue
            start, count = start[some], (stop - start)[some]
            it = _spans(start, count)
            offsets = np.append(0, np.cumsum(count))
            length = np.diff(at)[it]
            chars = data[_spans(at[it], length)]
            total = np.append(0, np.cumsum(length))[offsets]
            full = np.flatnonzero(np.diff(total))
            base = np.zeros(len(some), np.uint8)
            base[full] = np.minimum.reduceat(chars, total[:-1][full]) if len(full) else base[full]
            # ids without a byte have no list of bytes
            code = chars.astype(np.int64) - np.repeat(base, np.diff(total)) + 1
            text = pack_steps(code, np.append(total[:-1][full], total[-1]))
            where = np.full(len(some), -1)
            where[full] = np.arange(len(full))
            yield pa.RecordBatch.from_arrays(
                [me.take(pa.array(some)), pa.array(n[some]), pack_steps(length + 1, offsets), pack_steps(o_n[it], offsets),
                 pa.array(base.astype(np.int32)), text.take(pa.array(where, mask=where < 0))],
                names=["user_1", "n_1", "lengths", "sizes", "base", "ids"])
    return run


def _counted(batches):
    """Rows of ``_dealt`` sorted by user -> pairs with their number of common items."""
    held, entries, limit = [], 0, ENTRIES

    def out(user, n_1, row, name, n_2, times):
        codes = name.dictionary_encode()
        code, names = codes.indices.to_numpy().astype(np.int64), codes.dictionary
        size = np.zeros(len(names), np.int64)
        size[code] = n_2
        new = np.concatenate([[True], user[1:] != user[:-1]])
        group = np.cumsum(new) - 1
        key = (group[row] << 32) | code
        order = np.argsort(key) if times.max() > 1 else None
        key = np.sort(key) if order is None else key[order]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        shared = np.diff(np.append(at, len(key))) if order is None else np.add.reduceat(times[order], at)
        one, two = key[at] >> 32, key[at] & 0xFFFFFFFF
        return pa.RecordBatch.from_arrays(
            [pa.array(user[new], pa.string()).take(pa.array(one)), names.take(pa.array(two)), pa.array(shared),
             pa.array(n_1[new][one]), pa.array(size[two])], names=["user_1", "user_2", "shared", "n_1", "n_2"])

    def joined():
        start = np.cumsum([0, *[len(h[0]) for h in held]])
        return [np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]),
                np.concatenate([h[2] + s for h, s in zip(held, start, strict=False)]),
                pa.concat_arrays([h[3] for h in held]), np.concatenate([h[4] for h in held]), np.concatenate([h[5] for h in held])]

    for batch in batches:
        length, times = unpack_steps(batch.column("lengths"))
        length -= 1
        ids = batch.column("ids")
        code, many = unpack_steps(ids.drop_null())
        chars = np.zeros(len(batch), np.int64)
        chars[ids.is_valid().to_numpy(zero_copy_only=False)] = many
        data = (code - 1 + np.repeat(batch.column("base").to_numpy().astype(np.int64), chars)).astype(np.uint8)
        name = pa.Array.from_buffers(pa.string(), len(length), [None, pa.py_buffer(np.append(0, np.cumsum(length)).astype(np.int32)),
                                                                pa.py_buffer(data)])
        held.append((batch.column("user_1").to_numpy(zero_copy_only=False), batch.column("n_1").to_numpy(), np.repeat(np.arange(len(batch)), times),
                     name, unpack_steps(batch.column("sizes"))[0], np.ones(len(length), np.int64)))
        entries += len(length)
        if entries > limit:       # all but the last user are complete
            rows = joined()
            cut = int(np.flatnonzero(np.concatenate([[True], rows[0][1:] != rows[0][:-1]]))[-1])
            k = int(np.searchsorted(rows[2], cut))
            if cut:
                yield out(rows[0][:cut], rows[1][:cut], *[c[:k] for c in rows[2:]])
            rows = [rows[0][cut:], rows[1][cut:], rows[2][k:] - cut, *[c[k:] for c in rows[3:]]]
            if len(rows[2]) > limit // 2:       # so much of one user: its pairs so far, counted
                x = out(*rows)
                rows = [rows[0][:1], rows[1][:1], np.zeros(len(x), np.int64), x.column("user_2"),
                        x.column("n_2").to_numpy(), x.column("shared").to_numpy()]
            held, entries = [rows], len(rows[2])
            limit = max(ENTRIES, 4 * entries)
    if held:
        yield out(*joined())


def _all_pairs(left: DataFrame, right: DataFrame | None) -> DataFrame:
    """Every pair with a common item, through the items' lists of users."""
    chunks = _chunks(_rows(left))
    if right is None:
        hot = chunks.where("_chunks > 1")
        rows = chunks.where("_chunks = 1").select(F.col("users").alias("mine"), F.col("users").alias("others")).unionByName(
            hot.select("content_id", F.col("users").alias("mine")).join(
                hot.select("content_id", F.col("users").alias("others")), "content_id").drop("content_id"))
    else:
        rows = chunks.select("content_id", F.col("users").alias("mine")).join(
            _chunks(_rows(right)).select("content_id", F.col("users").alias("others")), "content_id").drop("content_id")
    dealt = rows.mapInArrow(_dealt(right is not None), "user_1 string, n_1 long, lengths binary, sizes binary, base int, ids binary")
    shared = dealt.repartition("user_1").sortWithinPartitions("user_1").mapInArrow(
        _counted, "user_1 string, user_2 string, shared long, n_1 long, n_2 long")
    return shared.withColumn("similarity", F.col("shared") / F.sqrt((F.col("n_1") * F.col("n_2")).cast("double")))


def block_similarity(left: DataFrame, right: DataFrame | None = None, blocks: int | None = None,
                     top_k: int | None = None) -> DataFrame:
    """Cosine similarity of binary rows ``(user_id, content_id)``.

    ``right=None`` means left against itself, emitting each pair once
    (user_1 < user_2; making the plan runs jobs that store the rows) unless ``top_k`` is set, in which case both directions
    are scored and each user keeps its best ``top_k`` per block pair."""
    if top_k is None:
        return _all_pairs(left, right)
    lu = _users(left)
    ru = lu if right is None else _users(right)
    if blocks is None:      # a scalar of the plan, no job of its own
        n = ru.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / BLOCK_USERS)).alias("n")).scalar()
    else:
        n = F.lit(blocks)
    rows = _block_pair_rows(lu, n, "L").unionByName(_block_pair_rows(ru, n, "R"))
    fn = lambda pdf: _pair_scores(pdf, top_k)
    return rows.groupBy("_lo", "_hi").applyInPandas(fn, PAIR_SCHEMA)
