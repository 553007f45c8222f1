"""Pairs through the items' lists, and recommendation scores, against plain Python."""
import random
from math import sqrt

import pytest

from reelhouse.operators import similarity
from reelhouse.plans import analytics as A
from reelhouse.plans import recommend as REC


def sets(rows):
    out = {}
    for u, c in rows:
        out.setdefault(u, set()).add(c)
    return out


@pytest.mark.parametrize("chunk", [3, 1024])
def test_all_pairs_without_blocks(spark, monkeypatch, chunk):
    monkeypatch.setattr(similarity, "CHUNK_USERS", chunk)
    monkeypatch.setattr(similarity, "_pair_scores", None)       # the blocks are not asked
    rnd = random.Random(5)
    rows = [(f"u{rnd.randrange(30)}", f"c{rnd.randrange(25)}") for _ in range(200)] + [(f"u{u}", "hot") for u in range(20)]
    have = sets(rows)
    right = [r for r in rows if rnd.random() < 0.7]
    other = sets(right)
    frame = lambda x: spark.createDataFrame(x, "user_id string, content_id string")
    value = lambda x, y: (len(x & y), len(x), len(y), round(len(x & y) / sqrt(len(x) * len(y)), 12))
    got = {(r[0], r[1]): (*r[2:5], round(r[5], 12)) for r in similarity.block_similarity(frame(rows)).collect()}
    assert got == {(u, v): value(x, y) for u, x in have.items() for v, y in have.items() if u < v and x & y}
    got = {(r[0], r[1]): (*r[2:5], round(r[5], 12)) for r in similarity.block_similarity(frame(rows), frame(right)).collect()}
    assert got == {(u, v): value(x, y) for u, x in have.items() for v, y in other.items() if u != v and x & y}


def test_scores_shuffle_no_row_a_title(spark):
    rnd = random.Random(6)
    rows = list({(f"u{rnd.randrange(20)}", f"c{rnd.randrange(40):02d}") for _ in range(300)}) + [("u1", None)]
    have = sets(rows)
    near = [(u, v, round(rnd.random(), 3)) for u in sorted(have) for v in rnd.sample(sorted(have), 5) if v != u]
    frame = lambda x, t: spark.createDataFrame(x, t)
    b = frame(rows, "user_id string, content_id string")
    out = REC._score(frame(near, "user_id string, neighbour_id string, similarity double"), b, b, 4)
    want = set()
    for u in have:
        score = {}
        for x, v, s in near:
            for c in have[v] if x == u else ():
                if c is None or c not in have[u]:
                    score.setdefault(c, []).append(s)
        best = sorted((-round(sum(s), 9), c is not None, c or "", len(s)) for c, s in score.items())[:4]
        want |= {(u, c if known else None, -s, n, place) for place, (s, known, c, n) in enumerate(best, 1)}
    assert {(r.user_id, r.content_id, r.recommendation_score, r.neighbours_watched, r.rec_rank) for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any("hashpartitioning(user_id" in line and "title" in line.split("hashpartitioning")[1].split(")")[0]
                   for line in plan.splitlines())


def test_queries_store_the_rows_of_users(wh):
    assert not any("/lineitem.parquet" in f for f in A.user_activity(wh).inputFiles())
    assert not any("/lineitem.parquet" in f for f in REC.recommend_one(wh).inputFiles())
