from .calendar import (date_key, day_name, month_name, mysql_week_monday, ym_label,
                       month_index, months_between_starts)
from .numeric import dec, mysql_div, mysql_avg, pct, safe_ratio, money_label, to_double
from .ordering import field_position
from .text import same_text

__all__ = [
    "date_key", "day_name", "month_name", "mysql_week_monday", "ym_label", "month_index",
    "months_between_starts", "dec", "mysql_div", "mysql_avg", "pct", "safe_ratio",
    "money_label", "to_double", "field_position", "same_text",
]
