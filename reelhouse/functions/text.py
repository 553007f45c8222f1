"""Text identity of the warehouse."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the warehouse's text columns compare without case, accents and trailing spaces.
TEXT_COLLATION = "UNICODE_CI_AI_RTRIM"


def same_text(col: str) -> Column:
    """``col`` as a text whose grouping, joins and comparisons follow the
    warehouse's collation. Its spelling is not changed; of a group it may be
    any member's, so take the wanted spelling from the row that stays."""
    return F.collate(F.col(col), TEXT_COLLATION)
