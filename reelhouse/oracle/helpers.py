"""SQL text helpers for the DuckDB oracle."""
from __future__ import annotations


def rdiv(num: str, den: str, digits: int) -> str:
    """num / den for integer-valued expressions, rounded half away from zero
    to ``digits`` decimals, as an exact DECIMAL. NULL when den is 0/NULL."""
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(NULLIF(({den}), 0) AS HUGEINT)"
    q = f"(sign({n}) * sign({d}) * ((2 * abs({n}) * {10 ** digits} + abs({d})) // (2 * abs({d}))))"
    base = f"CAST({q} AS DECIMAL(18,0))"
    if digits == 0:
        return f"({base})"
    unit = "0." + "0" * (digits - 1) + "1"
    return f"({base} * {unit})"


def mdiv(num: str, den: str, num_scale: int, den_scale: int = 0) -> str:
    """Warehouse division: num/den rounded to num_scale + 4 decimals.
    ``num`` holds a value with ``num_scale`` decimals, ``den`` with
    ``den_scale`` decimals (both exact)."""
    n = f"CAST(({num}) * {10 ** num_scale} AS HUGEINT) * {10 ** den_scale}"
    d = f"CAST(({den}) * {10 ** den_scale} AS HUGEINT) * {10 ** num_scale}"
    return rdiv(n, d, num_scale + 4)


def mavg(col: str, scale: int = 0) -> str:
    """AVG of an exact column with ``scale`` decimals, kept to scale + 4."""
    return rdiv(f"sum(CAST(({col}) * {10 ** scale} AS HUGEINT))", f"count({col}) * {10 ** scale}",
                scale + 4)


def pct(part: str, whole: str, digits: int) -> str:
    """ROUND(part * 100.0 / NULLIF(whole, 0), digits) for integer part/whole."""
    return f"ROUND({rdiv(f'({part}) * 100', whole, 5)}, {digits})"


def same_text(col: str) -> str:
    """A text without what the warehouse's comparisons ignore."""
    return f"lower(strip_accents(rtrim({col}, ' ')))"


def dbl(expr: str) -> str:
    return f"CAST(({expr}) AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST(({expr}) AS BIGINT)"


def sql_list(values) -> str:
    out = []
    for v in values:
        if v is None:
            out.append("NULL")
        elif isinstance(v, str):
            out.append("'" + v.replace("'", "''") + "'")
        else:
            out.append(str(v))
    return "[" + ", ".join(out) + "]"


def in_list(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"
