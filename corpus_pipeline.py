"""Corpus pipeline: quality, line dedup, near dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs. Stages keep the columns of
``documents``; the last one gives tokens. Rows with a null text count as empty
texts; a null doc_id is never labelled, never a copy and never dropped for its
id; an empty table goes through all stages as an empty table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import materialize
from reelhouse.llm.op1_lines import line_dedup
from reelhouse.llm.op2_neardup import near_duplicates
from reelhouse.llm.op3_bpe import bpe_documents
from reelhouse.llm.op4_quality import quality_scores
from reelhouse.llm.op10_decontam import decontaminate

#: Words of a shingle and percent of common shingles in the near-duplicate stage.
SHINGLE_WORDS, PERCENT = 5, 80


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(docs, labels).where("predicted = 1").select(*_columns(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that another one keeps."""
    out = line_dedup(docs).select(*_columns(docs))
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near copies."""
    gone = near_duplicates(docs, k=SHINGLE_WORDS, percent=PERCENT).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*_columns(docs))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark. Items under eight words count only as a whole text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark).where("not contaminated or only_short").select(*_columns(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the text they decode to, as digests."""
    return bpe_documents(docs, keep=["doc_id"]).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_copies), ("decontaminate", leaks),
          ("bpe", tokens)]

#: Scores of a network, word-level hashing and BPE cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, f"stage-{name}")
    return docs
