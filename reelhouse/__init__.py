"""reelhouse: a Spark-native streaming-video analytics warehouse.

Layers (all lazy DataFrame functions, nothing is collected):

* ``sources``   - test-table adapters, raw schemas, file/table sinks
* ``functions`` - column helpers (calendar, decimal rounding, ordering)
* ``operators`` - reusable distributed operators (global rank, month
  overlap, sessions, top-k, block similarity)
* ``plans``     - the warehouse: dimensions, facts, marts, views, the
  analysis queries, data quality, EDA, models and recommendations
* ``streaming`` - incremental append-only staging loads
* ``oracle``    - DuckDB SQL for the same outputs (correctness oracle)
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming", "oracle"]
