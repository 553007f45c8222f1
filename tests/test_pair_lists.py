"""Packed lists of ids: odd ids, users of very many rows, and what is shuffled."""
import random
from math import sqrt

import pytest

from reelhouse.operators import neighbours, scores, similarity
from reelhouse.plans import recommend as REC


def sets(rows):
    out = {}
    for u, c in rows:
        out.setdefault("None" if u is None else u, set()).add(c)
    return out


@pytest.mark.parametrize("entries, chunk", [(1 << 19, 1024), (7, 4)])
def test_pairs_of_odd_ids(spark, monkeypatch, entries, chunk):
    monkeypatch.setattr(similarity, "ENTRIES", entries)
    monkeypatch.setattr(similarity, "CHUNK_USERS", chunk)
    rnd = random.Random(8)
    ids = ["", "a", "\u00e9t\u00e9", "\U0001f600", "a b", "0", "00", None, "z" * 300, *[str(k) for k in range(95, 125)]]
    rows = [(rnd.choice(ids), f"c{rnd.randrange(12)}") for _ in range(150)] + [("big", f"c{c}") for c in range(12)]
    frame = spark.createDataFrame(rows + rows[:20], "user_id string, content_id string")
    have = sets(rows)
    got = {(r[0], r[1]): (*r[2:5], round(r[5], 12)) for r in similarity.block_similarity(frame).collect()}
    assert got == {(u, v): (len(x & y), len(x), len(y), round(len(x & y) / sqrt(len(x) * len(y)), 12))
                   for u, x in have.items() for v, y in have.items() if u.encode() < v.encode() and x & y}


def test_scores_in_pieces(spark, monkeypatch):
    """A user's titles are added up over several pieces."""
    monkeypatch.setattr(scores, "ENTRIES", 5)
    rnd = random.Random(9)
    rows = list({(f"u{rnd.randrange(12):02d}", f"c{rnd.randrange(30):02d}") for _ in range(140)})
    have = sets(rows)
    near = [(u, v, round(rnd.random(), 3)) for u in sorted(have) for v in rnd.sample(sorted(have), 6) if v != u]
    b = spark.createDataFrame(rows, "user_id string, content_id string")
    out = REC._score(spark.createDataFrame(near, "user_id string, neighbour_id string, similarity double"), b, b, 4)
    want = set()
    for u in have:
        score = {}
        for x, v, s in near:
            for c in have[v] - have[u] if x == u else ():
                score.setdefault(c, []).append(s)
        best = sorted((-round(sum(s), 9), c, len(s)) for c, s in score.items())[:4]
        want |= {(u, c, -s, n, place) for place, (s, c, n) in enumerate(best, 1)}
    assert {(r.user_id, r.content_id, r.recommendation_score, r.neighbours_watched, r.rec_rank) for r in out.collect()} == want


def test_lists_are_shuffled_packed(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y"), ("c", "y")], "user_id string, content_id string")
    for out, column in ((neighbours.nearest_users(rows), "list#"), (similarity.block_similarity(rows), "lengths#")):
        plan = out._jdf.queryExecution().optimizedPlan()
        dealt = []

        def look(node):
            if node.nodeName() == "RepartitionByExpression":
                dealt.append(node.child().output().toString())
            for i in range(node.children().size()):
                look(node.children().apply(i))
        look(plan)
        assert len(dealt) == 1 and column in dealt[0] and "others#" not in dealt[0]
