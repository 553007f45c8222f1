"""DuckDB SQL for the warehouse outputs, used as an independent oracle.

``oracle_query(name)`` returns one SQL string: the needed named steps as a
WITH chain over the driver's pre-registered test tables, then the final
SELECT. Exact half-up decimal division is written with integer arithmetic
(DuckDB divides decimals in floating point)."""
from .sql import FINALS, oracle_query

__all__ = ["FINALS", "oracle_query"]
