"""Exact dedup against a persistent digest index (DataFrame operations only).

The index is a table bucketed and sorted by digest. New rows are reduced to one
row per digest (map-side first, so a text that a third of all rows hold costs
one row per task), anti-joined with the index by a sort-merge join that does
not shuffle the index, and appended.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import ascii_lower, materialize, shared_path

#: Groups of at least 1/HEAVY of all rows: there are at most HEAVY of them.
HEAVY = 1024


def text_digest(text_col: str):
    """SHA-256 (hex) of the text with A-Z lowered; null counts as empty."""
    return F.sha2(ascii_lower(F.col(text_col)), 256)


class DigestIndex:
    """Digests seen so far with the id that was kept for each.

    ``name`` is a table of the session's catalog; its files lie in the shared
    folder (or at ``path``). Give the same name and path to go on with an
    index."""

    COLUMNS = "digest string, keep_id long, group_size long"

    def __init__(self, spark: SparkSession, name: str | None = None, path: str | None = None, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.name = name or "digest_index_" + uuid.uuid4().hex
        self.path = path or shared_path(spark, self.name)
        if not spark.catalog.tableExists(self.name):
            spark.sql(f"CREATE TABLE {self.name} ({self.COLUMNS}) USING parquet OPTIONS (path '{self.path}') "
                      f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> DataFrame:
        """Adds the digests of ``rows`` (id, digest) that the index lacks, each
        with its largest id, and returns the rows added. Digests the index has
        stay as they are."""
        groups = rows.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        new = materialize(groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti"), "digests")
        (new.select("digest", "keep_id", "group_size").repartition(self.buckets, "digest").write.format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").mode("append").option("path", self.path)
         .saveAsTable(self.name))
        return new


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of every
    row. Texts are equal when identical after lower-casing A-Z; null counts as
    empty. Of equal texts that the index does not have yet, the largest id
    stays; those that it has are dropped in favour of the id it names, with the
    group size it recorded. The row of that very id stays, so a batch given
    again, as after a lost driver, gets the answers it got the first time.

    Null ids lose against all others; a group of null ids only has a null
    ``keep_id`` and keeps all its rows (in later batches too: they cannot be
    told from a repeated batch). Rows that repeat an id count one by one
    and are all kept if that id is the largest. An empty table gives an empty
    table. Other columns are not read."""
    index = index or DigestIndex(docs.sparkSession)
    rows = materialize(docs.select(F.col(id_col).cast("long").alias("id"), text_digest(text_col).alias("digest")),
                       "row-digests")
    index.append(rows)
    known = index.table()
    total = rows.count()
    # Heavy groups are joined by broadcast (HEAVY rows at most), so that no task gets all rows of one text.
    heavy = F.broadcast(known.where(F.col("group_size") * HEAVY >= total))
    light = known.where(F.col("group_size") * HEAVY < total)
    marks = rows.join(F.broadcast(known.where(F.col("group_size") * HEAVY >= total).select("digest")), "digest",
                      "left_anti")
    out = rows.join(heavy, "digest").unionByName(marks.join(light.hint("merge"), "digest"))
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size",
                      F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.col("digest").alias("text_sha256"))
