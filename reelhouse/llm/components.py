"""Connected components of a link table: union-find in tasks, then stars."""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import materialize

#: Links that one task joins by union-find (about 100 MB).
LINKS_PER_TASK = 500_000


def union_find(pairs) -> dict[int, int]:
    """Smallest node of the component of each node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def _contract(batches):
    pairs = [(a, b) for batch in batches
             for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
    tops = union_find(pairs)
    yield pa.RecordBatch.from_arrays([pa.array(list(tops), pa.int64()), pa.array(list(tops.values()), pa.int64())],
                                     names=["a", "b"])


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, links_per_task: int = LINKS_PER_TASK) -> DataFrame:
    """(node, top) for every node of the links (a, b): the smallest node it
    reaches. Each task first replaces its share of the links by a forest; where
    there is more than one share, rounds of large and small stars join them
    (every round halves paths at least, and reads and writes the link table
    once). Nothing is collected to the driver."""
    links = materialize(links.select(F.col("a").cast("long"), F.col("b").cast("long")), "links")
    shares = max(1, -(-links.count() // links_per_task))
    forest = links.repartition(shares).mapInArrow(_contract, "a long, b long")
    if shares == 1:
        return materialize(forest, "components").toDF("node", "top")
    now = materialize(forest.where("a <> b").distinct(), "forest")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.toDF("a", "b")).where("a <> b").distinct())
        now = materialize(small, "forest")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    tops = now.select(F.col("a").alias("node"), F.col("b").alias("top"))
    return materialize(tops.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("top")).distinct()),
                       "components")
