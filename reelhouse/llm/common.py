"""Shared folder, materialised tables and 64-bit mixing for the operators."""
from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space of all contracts: [\x20\x09-\x0D].
SPACES = b" \t\n\x0b\x0c\r"

_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``). Only a local
    session without that setting gets a private folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="reelhouse-llm-")
    return _own_folder[app]


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    and a lost executor costs only the tasks that read from it."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(col):
    """A-Z to a-z only. ``lower`` has a fast path that is right for pure ASCII."""
    col = F.coalesce(col, F.lit(""))
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, LOWER))


def volume(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Rows and text bytes of a table."""
    row = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(text_col).cast("long"))).first()
    return row[0], row[1] or 0


def buckets_for(n_bytes: int) -> int:
    """Number of document buckets: a bucket holds 2 MB of text, and up to 64 MB
    where the table is larger than 512 MB, so that a bucket fits a task and
    very large tables do not have too many."""
    size = min(max(n_bytes // 256, 2 << 20), 64 << 20)
    return max(1, -(-n_bytes // size))


def bucket_of(id_col: str, text_col: str, n: int):
    """Even spread of rows, also where ids repeat or are null."""
    return F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(n)).cast("int")


def with_columns(schema, **more):
    """A copy of a StructType with columns added; a column of the same name
    (any case) is replaced."""
    from pyspark.sql.types import StructField, StructType
    names = {k.lower() for k in more}
    return StructType([f for f in schema.fields if f.name.lower() not in names]
                      + [StructField(k, v, True) for k, v in more.items()])


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        return [x or b"" for c in column.chunks for x in c.cast(pa.binary()).to_pylist()]
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_GOLDEN = 0x9E3779B97F4A7C15
GOLDEN = np.uint64(_GOLDEN)


def golden(k: int) -> np.uint64:
    """k times the golden-ratio constant, modulo 2^64."""
    return np.uint64(k * _GOLDEN % (1 << 64))
