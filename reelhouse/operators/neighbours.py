"""Exact nearest users by cosine over binary rows, through an inverted index
with bounds.

A user's common titles with all others come from the posting lists of its
titles, gathered per user and counted with numpy; no pair of users is a row.
A list goes to each of its users, so lists must be short. Titles of more than
``HOT`` users are hot; their lists are cut into chunks of ``HOT`` users with
the fewest titles first, and are read in two rounds:

1. All lists of rare titles, and the first chunk of each hot title. That gives
   every pair with a common rare title. A pair's similarity lies between what
   was counted and that plus the user's hot titles; pairs whose upper bound
   is below the user's k-th best lower bound go. The rest are settled by
   intersecting the two users' hot titles. Now the k-th best similarity s of
   each user is a lower bound of the final one.
2. Pairs that were not seen have hot titles in common only, at most h, the
   user's number of them: h / sqrt(n_1 * n_2) >= s needs n_2 <= (h / s)^2 / n_1.
   Later chunks are read up to that number of titles; their pairs are settled
   in the same way.

So a hot title costs a user one chunk, and more only where its bound is weak.
No neighbour is lost. Ties go by user id. Users reached by one user are dealt in ``parts`` of
at most ``PART_USERS``, so that no task holds more of them.

The lists are what is shuffled most: each goes to every user of its title. They
are sent as packed numbers (``packed``). Users are numbered in the order of
their number of titles, then id, so that a number tells the number of titles
by a table of the distinct ones, and of the users with equally many common
titles those with the smallest numbers are the nearest.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packed import pack, unpack
from .stored import numbered, store, store_in_order
from .topk import top_k_per_key

#: Users of a title whose posting list is sent to each of them; users of a chunk of a longer list.
HOT = 1024
PART_USERS = 1 << 24
#: Entries that a task counts at once.
ENTRIES = 1 << 21

_COUNTED = "uid long, n_1 long, h long, other long, n_2 long, rare long"
_V = np.int64((1 << 40) - 1)


def _runs(x: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _place(group: np.ndarray) -> np.ndarray:
    """Place of each element in its run of equal values."""
    first = _runs(group)
    return np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))


def _nearest(group, other, shared, n_1, n_2, k: int) -> np.ndarray:
    """Of exact counts by (group, other): which can be among the best k of their
    group. Of equally many common titles the smallest numbers are nearest."""
    one = np.flatnonzero(shared == 1)
    one = one[_place(group[one]) < k]
    more = np.flatnonzero(shared > 1)
    more = more[np.lexsort((other[more], -shared[more], group[more]))]
    more = more[_place((group[more] << 32) - shared[more]) < k]
    at = np.concatenate([one, more])
    value = shared[at] / np.sqrt((n_1[at] * n_2[at]).astype(np.float64))
    order = np.lexsort((-value, group[at]))
    at, value = at[order], value[order]
    first, place = _runs(group[at]), _place(group[at])
    size = np.diff(np.append(first, len(at)))
    kth = np.repeat(value[first + np.minimum(size, k) - 1], size)
    return at[(place < k) | (value == kth)]      # users at the k-th place's value are ranked by id later


def _bounded(group, other, rare, hot, n_1, n_2, h, k: int) -> np.ndarray:
    """Of counts of some titles by (group, other), ``h`` hot titles of the user in all: which can be among its best k."""
    n = np.sqrt((n_1 * n_2).astype(np.float64))
    low, high = (rare + hot) / n, (rare + np.minimum(h, n_2 - rare)) / n
    order = np.lexsort((-low, group))
    first = _runs(group[order])
    size = np.diff(np.append(first, len(order)))
    kth = np.where(size >= k, low[order][first + np.minimum(size, k) - 1], 0)
    return order[high[order] >= np.repeat(kth, size) * (1 - 1e-12)]


def _summed(group, key, rare, hot):
    """Sums by (group, key), sorted."""
    order = np.lexsort((key, group))
    group, key, rare, hot = group[order], key[order], rare[order], hot[order]
    at = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])])) if len(key) else []
    return (group, key, rare, hot) if not len(key) else (group[at], key[at], np.add.reduceat(rare, at), np.add.reduceat(hot, at))


def _count(k: int, from_uid: np.ndarray, sizes: np.ndarray, extra: list[str]):
    """Counts the common titles of each user, rows sorted by (part, uid). ``sizes`` are the numbers of titles of the users
    ``from_uid`` on; ``extra`` the columns there are beside part, uid and list."""
    def of(users):
        return sizes[np.searchsorted(from_uid, users, "right") - 1]

    def out(users, x):
        group, other, rare, hot = x
        uid, n_1, h = (c[group] for c in users)
        n_2 = of(other)
        at = _bounded(group, other, rare, hot, n_1, n_2, h, k) if h.any() else _nearest(group, other, rare + hot, n_1, n_2, k)
        return pa.RecordBatch.from_arrays([pa.array(c[at]) for c in (uid, n_1, h, other, n_2, rare)],
                                          names=["uid", "n_1", "h", "other", "n_2", "rare"])

    def run(batches):
        held, entries, rest = [], 0, None       # rest: the counts so far of the last user, who may go on

        def flush(all_: bool):
            nonlocal held, entries, rest
            rows = [np.concatenate([h[c] for h in held]) for c in range(6)]
            part, uid, n_1, h, times = rows[0], rows[1], rows[2], rows[3], rows[5]
            new = np.concatenate([[True], (part[1:] != part[:-1]) | (uid[1:] != uid[:-1])])
            group = np.cumsum(new) - 1
            users = [c[new] for c in (uid, n_1, h)]
            key = (np.repeat(group, times) << 41) | (np.concatenate([x[6] for x in held]) << 1) | np.repeat(rows[4], times)
            key = key[((key >> 1) & _V) != np.repeat(uid, times)]
            key.sort()
            pair = key >> 1
            first = _runs(pair)
            hot = np.add.reduceat(key & 1, first) if len(first) else first
            rare = np.diff(np.append(first, len(key))) - hot
            x = (pair[first] >> 40, pair[first] & _V, rare, hot)
            if rest is not None:
                if rest[0] == (int(part[0]), int(uid[0])):
                    cut = int(np.searchsorted(x[0], 1))
                    x = [np.concatenate([a, b[cut:]]) for a, b in
                         zip(_summed(*[np.concatenate([a, b[:cut]]) for a, b in zip(rest[2], x, strict=True)]), x, strict=True)]
                else:
                    yield out(rest[1], rest[2])
            last = len(users[0]) - 1
            cut = len(x[0]) if all_ else int(np.searchsorted(x[0], last))
            if cut:
                yield out(users, [c[:cut] for c in x])
            rest = None if all_ else ((int(part[-1]), int(uid[-1])), [c[last:] for c in users],
                                      [x[0][cut:] * 0, *[c[cut:] for c in x[1:]]])
            held, entries = [], 0

        for batch in batches:
            uid = batch.column("uid").to_numpy(zero_copy_only=False).astype(np.int64)
            other, times = unpack(batch.column("list"))
            c = {n: batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ["part", *extra]}
            held.append((c["part"], uid, c["n_1"] if "n_1" in c else of(uid), c.get("h", uid * 0), c.get("hot", uid * 0), times, other))
            entries += len(other)
            if entries > ENTRIES:
                yield from flush(False)
        if held:
            yield from flush(True)
        elif rest is not None:
            yield out(rest[1], rest[2])
    return run


def _pack(parts: int):
    """Of each title's ``others``: packed lists of the users of each part, beside its other columns."""
    def run(batches):
        for batch in batches:
            others = batch.column("others")
            times = np.diff(others.offsets.to_numpy())
            v = others.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(times)) * parts, times) + v % parts
            order = np.lexsort((v, row))
            row, v = row[order], v[order]
            first = _runs(row)
            row = row[first]
            names = [n for n in batch.schema.names if n != "others"]
            title = pa.array(row // parts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n).take(title) for n in names], pa.array(row % parts).cast(pa.int32()),
                 pack(v, np.append(first, len(v)))], names=[*names, "part", "list"])
    return run


def _profiles(left: DataFrame, right: DataFrame | None) -> DataFrame:
    """user_id, mine, theirs (the sets of titles of both sides; theirs only if there is a right side), n_1, n_2."""
    rows = left.select("user_id", "content_id", F.lit(True).alias("_left"))
    if right is not None:
        rows = rows.unionByName(right.select("user_id", "content_id", F.lit(False).alias("_left")))

    def side(which, name: str, n: str) -> list:
        # no title is one title too
        return [F.collect_set(F.when(which, F.col("content_id"))).alias(name),
                F.max((which & F.col("content_id").isNull()).cast("int")).alias(n)]
    both = side(F.col("_left"), "mine", "n_1") + (side(~F.col("_left"), "theirs", "n_2") if right is not None else [])
    sets = rows.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(*both)
    sets = sets.withColumn("n_1", (F.size("mine") + F.col("n_1")).cast("long"))
    return (sets.withColumn("n_2", F.col("n_1")) if right is None else
            sets.withColumn("n_2", (F.size("theirs") + F.col("n_2")).cast("long")))


def nearest_users(left: DataFrame, right: DataFrame | None = None, k: int = 20) -> DataFrame:
    """user_1, user_2, shared, n_1, n_2, similarity, neighbour_rank: the ``k``
    most similar users of each user of ``left`` among those of ``right`` (left
    itself by default), by cosine of their sets of titles ``(user_id,
    content_id)``. Only users with a common title are neighbours; a user is not
    its own. Making the plan runs jobs that store what is read more than once."""
    if k >= HOT:
        raise ValueError("k must be below HOT")
    spark = left.sparkSession
    ranges = max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    profiles = store(_profiles(left, right), "profiles")
    users = numbered(store_in_order(profiles.select("user_id", "n_1", "n_2"), [F.col("n_2"), F.col("user_id")], ranges), "uid")
    users = store(users.select("user_id", "uid", "n_1", "n_2"), "users")
    # a row for each number of titles that occurs, far fewer than users
    table = users.groupBy("n_2").agg(F.min("uid").alias("uid")).toArrow().sort_by("uid")
    from_uid, sizes = (table.column(c).to_numpy() for c in ("uid", "n_2"))
    n_users = users.count()
    parts = max(1, -(-n_users // PART_USERS))
    uid = F.col("uid").cast("int" if n_users < (1 << 31) - 1 else "long").alias("uid")
    theirs = "mine" if right is None else "theirs"
    hot = store(profiles.select(F.explode(theirs).alias("content_id")).groupBy("content_id").agg(
        F.count(F.lit(1)).alias("c")).where(F.col("c") > HOT).select("content_id"), "hot-titles")
    some_hot = not hot.isEmpty()

    named = profiles.join(users.select("user_id", "uid"), "user_id")
    own = [uid, "n_1"] if right is not None or some_hot else [uid]
    mine = named.select(*own, F.explode("mine").alias("content_id"))
    listed = named.select(uid, "n_2", F.explode(theirs).alias("content_id"))
    if some_hot:
        listed = store(listed.join(hot.withColumn("hot", F.lit(True)), "content_id", "left").fillna(False, ["hot"]), "listed")
        hot_sets = listed.where("hot").groupBy("uid").agg(F.collect_set("content_id").alias("hot_titles"))
        mine = mine.join(hot.withColumn("hot", F.lit(True)), "content_id", "left").fillna(False, ["hot"])
        mine_hot = mine.where("hot").groupBy("uid").agg(F.collect_set("content_id").alias("own_hot"))
        mine = store(mine.join(mine_hot.select("uid", F.size("own_hot").cast("long").alias("h")), "uid", "left")
                     .fillna(0, ["h"]), "mine")
    extra = [c for c in ("n_1", "h", "hot") if right is not None and c == "n_1" or some_hot]

    def lists(rows: DataFrame) -> DataFrame:
        """Rows (..., others) with packed lists."""
        kept = [f for f in rows.schema.fields if f.name != "others"]
        schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "part int", "list binary"])
        return rows.mapInArrow(_pack(parts), schema)

    def candidates(rows: DataFrame) -> DataFrame:
        """Of rows (part, uid, list, ...): pairs that can be among a user's best k."""
        return (rows.select("part", "uid", "list", *extra).repartition("part", "uid")
                .sortWithinPartitions("part", "uid").mapInArrow(_count(k, from_uid, sizes, extra), _COUNTED))

    me = F.struct(*[F.col(c) for c in ("uid", *[c for c in ("n_1", "h") if c in extra])])
    if right is None and not some_hot:      # the users of a title are its list
        rows = lists(listed.groupBy("content_id").agg(F.collect_list("uid").alias("others")).select(
            F.col("others").alias("mine"), "others")).select(F.explode("mine").alias("uid"), "part", "list")
    else:
        rare = (listed.where("not hot"), mine.where("not hot")) if some_hot else (listed, mine)
        both = rare[0].select("content_id", F.col("uid").alias("other"), F.lit(None).cast(rare[1].select(me.alias("me")).schema["me"].dataType).alias("me"))
        both = both.unionByName(rare[1].select("content_id", F.lit(None).cast(dict(rare[0].dtypes)["uid"]).alias("other"), me.alias("me")))
        both = both.groupBy("content_id").agg(F.collect_list("other").alias("others"), F.collect_list("me").alias("mine"))
        rows = lists(both.where(F.size("others") > 0).select("mine", "others")).select(F.explode("mine").alias("me"), "part", "list")
        rows = rows.select("me.*", "part", "list", *([F.lit(False).alias("hot")] if some_hot else []))
    if some_hot:
        in_order = numbered(store_in_order(listed.where("hot"), [F.col(c) for c in ("content_id", "n_2", "uid")], ranges), "number")
        first = in_order.groupBy("content_id").agg(F.min("number").alias("first"))
        chunks = (in_order.join(first, "content_id")
                  .groupBy("content_id", F.floor((F.col("number") - F.col("first")) / HOT).alias("chunk"))
                  .agg(F.collect_list("uid").alias("others"), F.min("n_2").alias("least")))
        chunks = store(lists(chunks), "chunks")
        rows = rows.unionByName(mine.where("hot").join(chunks.where("chunk = 0"), "content_id").select(*rows.columns))
    similarity = F.col("shared") / F.sqrt((F.col("n_1") * F.col("n_2")).cast("double"))
    found = candidates(rows)
    if some_hot:
        def settle(pairs_: DataFrame) -> DataFrame:
            both = F.size(F.array_intersect("own_hot", "hot_titles"))
            return (pairs_.join(mine_hot, "uid", "left")
                    .join(hot_sets.withColumnRenamed("uid", "other"), "other", "left")
                    .withColumn("shared", F.col("rare") + F.when(both > 0, both).otherwise(0))
                    .where("shared > 0").select("uid", "other", "n_1", "n_2", "shared", similarity.alias("similarity")))

        seen = store(settle(found), "settled")
        rank = top_k_per_key(seen, "uid", [F.col("similarity").desc(), F.col("other")], k, rank_col="place")
        kth = rank.where(F.col("place") == k).select("uid", F.col("similarity").alias("s"))
        # a little more than the bound, for rounding
        reach = mine.where("hot").join(kth, "uid", "left").withColumn(
            "most", F.col("h") * F.col("h") / (F.col("s") * F.col("s") * F.col("n_1")) * (1 + 1e-9))
        more = reach.join(chunks.where("chunk > 0"), "content_id").where(F.col("s").isNull() | (F.col("least") <= F.col("most")))
        late = settle(candidates(more))
        # a pair of both rounds counts with what the first one found
        found = seen.unionByName(late).groupBy("uid", "other").agg(F.max("shared").alias("shared"))
    else:
        found = found.select(uid, F.col("other").cast("int" if n_users < (1 << 31) - 1 else "long").alias("other"),
                             F.col("rare").cast("int").alias("shared"))
    # the numbers of titles and names are looked up again, so that little is shuffled
    found = found.join(users.select(F.col("uid").alias("other"), F.col("user_id").alias("user_2"), "n_2"), "other")
    found = found.select("uid", "user_2", "n_2", "shared").join(
        users.select("uid", F.col("user_id").alias("user_1"), "n_1"), "uid")
    top = top_k_per_key(found.withColumn("shared", F.col("shared").cast("long")).withColumn("similarity", similarity), "uid",
                        [F.col("similarity").desc(), F.col("user_2")], k, rank_col="neighbour_rank")
    return top.select("user_1", "user_2", "shared", "n_1", "n_2", "similarity", "neighbour_rank")
