"""Runs with substitutions against brute force over all placements."""
import itertools
import random

import numpy as np
import pytest

from reelhouse.llm.op10_decontam import MASKS, MIN_RUN, SHORT_MASKS, Items, decontaminate

ITEM = np.arange(1, 61, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def found(n, gone, around=5):
    """Equal words found for an item of n words with substitutions, inside other text."""
    items = Items([1], [ITEM[:n]])
    text = np.arange(10**6, 10**6 + n + 2 * around, dtype=np.uint64)
    keep = [k for k in range(n) if k not in gone]
    text[[around + k for k in keep]] = ITEM[keep]
    hits = items.hits(np.zeros(len(text), np.int64), text)
    return max((items.run(text, 0, len(text), item, start) for _, item, start in hits), default=0)


def brute(n, gone):
    """Whether a stretch of 13 words or more, or the whole shorter item, has 80 % equal words."""
    equal = [k not in gone for k in range(n)]
    return any(5 * sum(equal[a:b]) >= 4 * (b - a) for a in range(n) for b in range(a + min(MIN_RUN, n), n + 1))


@pytest.mark.parametrize("n, most", [(8, 2), (9, 2), (10, 3), (11, 3), (12, 3), (13, 3), (14, 3), (15, 4), (20, 4)])
def test_all_placements(n, most):
    for k in range(most + 1):
        for gone in itertools.combinations(range(n), k):
            assert bool(found(n, gone)) == brute(n, gone), gone
            if n >= 13 and (k <= 2 or n == 20):
                assert found(n, gone), gone


def test_random_placements():
    rng = random.Random(5)
    for _ in range(3000):
        n = rng.randrange(21, 61)
        gone = set(rng.sample(range(n), rng.randrange(n // 7, n // 3)))
        assert bool(found(n, gone)) == brute(n, gone), (n, gone)


def test_masks_miss_no_long_run():
    """The best score (+1 equal, -4 different) of a run of each length without a hit is negative."""
    best = {(): 0}
    for length in range(1, 120):
        step = {}
        for last, score in best.items():
            for bit in "01":                                        # 1: the word differs
                bits = (*last, bit)
                if any(len(bits) >= len(m) and ("1", "1") not in zip(m, bits[-len(m):], strict=True) for m in MASKS):
                    continue
                step[bits[-7:]] = max(step.get(bits[-7:], -10**6), score + (-4 if bit == "1" else 1))
        best = step
        assert length < MIN_RUN or max(best.values()) < 0, length
    assert max(map(len, MASKS)) <= 8 and max(map(len, SHORT_MASKS)) <= 8


def test_two_substitutions_anywhere(spark):
    words = [f"q{k}" for k in range(13)]
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    cases = [g for k in range(4) for g in itertools.combinations(range(13), k)]
    rows = [(i, "before " + " ".join("x" if k in g else w for k, w in enumerate(words)) + " after")
            for i, g in enumerate(cases)]
    got = decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert len(got) == len(cases) == 378
    for r in got:
        k = len(cases[r.doc_id])
        assert (r.contaminated, r.item_ids, r.longest_match) == ((True, [7], 13 - k) if k <= 2 else (False, [], 0))


def test_short_items(spark, tmp_path):
    import corpus_pipeline
    long_item = " ".join(f"q{k}" for k in range(20))
    spark.createDataFrame([(1, "yes"), (2, long_item), (None, "no way"), (4, "a b c d e f g"), (5, "a b c d e f g h")],
                          "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "Oh yes it is"), (2, "YES"), (3, f"yes {long_item}"), (4, "there is no way out"), (5, "no way"),
            (6, "x a b c d e f g"), (7, "x a b c d e f g h"), (8, "clean"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.contaminated, r.item_ids, r.short_item_ids, r.only_short)
           for r in decontaminate(docs, spark.read.parquet(f"{tmp_path}/benchmark.parquet")).collect()}
    assert got == {1: (True, [1], [1], True), 2: (True, [1], [], False), 3: (True, [1, 2], [1], False),
                   4: (True, [], [], True), 5: (True, [], [], False), 6: (True, [4], [4], True),
                   7: (True, [4, 5], [4], False), 8: (False, [], [], False), 9: (False, [], [], False)}
    left = corpus_pipeline.leaks(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in left.collect()) == [1, 4, 6, 8, 9] and left.columns == docs.columns


def test_join_of_a_large_benchmark(spark, monkeypatch):
    """A benchmark over the broadcast size gives the same rows, and no rows of it go to the driver."""
    from pyspark.sql import functions as F

    from reelhouse.llm import op10_decontam
    sf = "/root/testdata/sf0.001"
    odd = [(1, "x", "yes"), (1, "x", "yes"), (None, "y", "oh yes a b c d e f g h i"), (2, "z", None), (3, "z", ""),
           (4, "z", "a b c d x f g h i"), (5, "z", " ".join(f"q{k}" if k % 7 else "no" for k in range(13)))]
    docs = spark.createDataFrame(odd, "doc_id long, lang string, text string").unionByName(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text"))
    items = [(1001, "yes"), (1002, "a b c d e f g h i"), (None, "oh yes"), (1003, ""), (1004, None),
             (1005, " ".join(f"q{k}" for k in range(13)))]
    bench = spark.createDataFrame(items, "item_id long, text string").unionByName(
        spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text"))
    key = lambda frame: sorted(map(str, frame.collect()))
    want = key(decontaminate(docs, bench))
    monkeypatch.setattr(op10_decontam, "BROADCAST_WORDS", 100)

    def never(*_, **__):
        raise AssertionError("rows of the benchmark at the driver")
    monkeypatch.setattr(type(docs), "toLocalIterator", never)
    out = decontaminate(docs, bench)
    assert key(out) == want
    assert out.where("contaminated").count() > 4 and out.where(F.col("item_ids").isNull()).count() == 0
    assert decontaminate(docs.limit(0), bench).count() == 0
