"""Pairs of shingles with many members: a fixed number of rounds, whatever the members."""
import random

import numpy as np
import pytest

from llm_brute import brute_near
from reelhouse.llm import op2_neardup
from reelhouse.llm.op2_neardup import bitmaps, near_duplicates


@pytest.mark.parametrize("seed", [4, 5])
def test_rounds_do_not_grow_with_the_members(spark, monkeypatch, seed):
    names, plain = [], op2_neardup.materialize
    monkeypatch.setattr(op2_neardup, "OPEN", 3)
    monkeypatch.setattr(op2_neardup, "materialize", lambda df, name: (names.append(name), plain(df, name))[1])
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):       # around the threshold, of many sizes: some groups with shingles in common stay apart
        words = base[:rng.choice([40, 45, 50, 55, 60])]
        for _ in range(rng.choice([0, 1, 3, 4, 5, 6])):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in out.collect()} == brute_near(rows, 2, 80)
    assert names.count("open") == 2


def test_bitmaps_bound_the_different_elements():
    rng = np.random.default_rng(1)
    for n, m in ((1, 1), (5, 4), (200, 190), (3000, 10)):
        x = rng.integers(-2**63, 2**63 - 1, n)
        y = np.concatenate([x[:m // 2], rng.integers(-2**63, 2**63 - 1, m - m // 2)])
        a, b = (sum(int(w) % 2**64 << 64 * i for i, w in enumerate(row)) for row in bitmaps([x, y]))
        assert (a ^ b).bit_count() <= len(set(x.tolist()) ^ set(y.tolist()))
    assert bitmaps([]).shape == (0, op2_neardup.WORDS)
