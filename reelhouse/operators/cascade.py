"""Deletes that follow foreign keys."""
from __future__ import annotations

from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cascade(tables: dict[str, DataFrame], foreign_keys: list[tuple[str, str, str, str]],
            delete: dict[str, Column]) -> dict[str, DataFrame]:
    """``tables`` without the rows that ``delete`` names (table -> condition)
    and without all rows that refer to a deleted row, over any number of levels.

    ``foreign_keys`` are (child, child column, parent, parent column). A NULL
    reference, or one to a row that never was, is no reference to a deleted
    row and stays; so does a row whose condition is NULL. A table may not refer
    to itself, directly or through others (``graphlib.CycleError``). Each
    reference is one left join with the distinct deleted keys of the parent;
    a key that a third of the child's rows hold is split by AQE."""
    before = {t: {p for c, _, p, _ in foreign_keys if c == t} for t in tables}
    kept: dict[str, DataFrame] = {}
    gone: dict[str, DataFrame] = {}
    parents = {p for _, _, p, _ in foreign_keys}
    for name in TopologicalSorter(before).static_order():
        rows = tables[name]
        marked = rows.withColumn("_gone", F.coalesce(delete.get(name, F.lit(False)), F.lit(False)))
        for child, column, parent, key in foreign_keys:
            if child == name and parent in gone:
                keys = gone[parent].select(F.col(key).alias("_key")).distinct().withColumn("_hit", F.lit(True))
                marked = marked.join(keys, F.col(column) == F.col("_key"), "left") \
                    .withColumn("_gone", F.col("_gone") | F.col("_hit").isNotNull()).drop("_key", "_hit")
        touched = name in delete or any(c == name and p in gone for c, _, p, _ in foreign_keys)
        kept[name] = marked.filter(~F.col("_gone")).drop("_gone") if touched else rows
        if touched and name in parents:
            gone[name] = marked.filter("_gone").drop("_gone")
    return {name: kept[name] for name in tables}
