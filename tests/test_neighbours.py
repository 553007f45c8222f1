"""Nearest users against all pairs."""
import random
from math import sqrt

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import neighbours


def brute(left, right, k):
    def sets(rows):
        out = {}
        for u, t in rows:
            out.setdefault(u, set()).add(t)
        return out
    a, b = sets(left), sets(right)
    want = set()
    for u, x in a.items():
        near = [(-len(x & y) / sqrt(len(x) * len(y)), v, len(x & y)) for v, y in b.items() if v != u and x & y]
        for place, (s, v, c) in enumerate(sorted(near)[:k], 1):
            want.add((u, v, c, len(x), len(b[v]), round(-s, 12), place))
    return want


def rows_of(users, seed, hot):
    """Titles of all degrees: ``hot`` titles that a third and more of the users have, users with a title or two, a user with all."""
    rnd = random.Random(seed)
    rows = []
    for u in range(users):
        n = rnd.choice([1, 1, 2, 3, 8, 20])
        rows += [(f"u{u:03d}", f"t{rnd.randrange(60):02d}") for _ in range(n)]
        rows += [(f"u{u:03d}", f"hot{h}") for h in range(hot) if rnd.random() < 0.4]
    return rows + [("u000", f"t{t:02d}") for t in range(60)] + rows[:20]


@pytest.mark.parametrize("limit, hot", [(1024, 3), (6, 3), (6, 0), (40, 12)])
def test_nearest_users(spark, monkeypatch, limit, hot):
    monkeypatch.setattr(neighbours, "HOT", limit)
    monkeypatch.setattr(neighbours, "ENTRIES", 500)
    monkeypatch.setattr(neighbours, "PART_USERS", 50)
    rows = rows_of(120, limit + hot, hot)
    got = neighbours.nearest_users(spark.createDataFrame(rows, "user_id string, content_id string"), k=4)
    assert {(*r[:5], round(r[5], 12), r[6]) for r in got.collect()} == brute(rows, rows, 4)


def test_nearest_users_of_other_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "HOT", 8)
    rows = rows_of(80, 3, 4)
    left = [r for k, r in enumerate(rows) if k % 3]
    frame = lambda x: spark.createDataFrame(x, "user_id string, content_id string")
    got = neighbours.nearest_users(frame(left), frame(rows), k=5)
    assert {(*r[:5], round(r[5], 12), r[6]) for r in got.collect()} == brute(left, rows, 5)


def test_nearest_users_of_no_rows(spark):
    none = spark.createDataFrame([], "user_id string, content_id string")
    assert neighbours.nearest_users(none).count() == 0
    alone = spark.createDataFrame([("a", "x"), ("b", "y")], "user_id string, content_id string")
    assert neighbours.nearest_users(alone).count() == 0


def test_no_pair_of_users_is_a_row(wh):
    """Of all plans that run, none makes more rows than the interactions times the neighbours."""
    from reelhouse.plans.recommend import similar_users_topk
    out = similar_users_topk(wh)
    assert out.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 20
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()
