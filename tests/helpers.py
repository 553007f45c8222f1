import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    return v


def sort_key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def same_rows(a, b):
    a = sorted([tuple(norm(v) for v in r) for r in a], key=sort_key)
    b = sorted([tuple(norm(v) for v in r) for r in b], key=sort_key)
    return a == b, a, b
