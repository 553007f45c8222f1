"""Ordering helpers."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field_position(col, values) -> Column:
    """1-based position of ``col`` in ``values``; 0 on a miss or NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in values]), c), F.lit(0)).cast("int")
