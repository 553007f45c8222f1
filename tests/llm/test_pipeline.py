"""The pipeline stage by stage."""
import pytest

import corpus_pipeline as p
from llm_brute import brute_near
from reelhouse.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs.toPandas())
    for name, stage in p.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        out.append(docs.toPandas())
    return out


def test_stages_keep_the_columns_and_narrow(steps):
    assert [n for n, _ in p.STAGES] == ["quality", "line_dedup", "near_dedup", "decontaminate", "bpe"]
    for before, after in zip(steps, steps[1:-1], strict=False):
        assert list(after.columns) == list(steps[0].columns)
        assert set(after.doc_id) <= set(before.doc_id)
    assert set(steps[-1].doc_id) == set(steps[-2].doc_id)
    assert (steps[2].n_chars == steps[2].text.str.len()).all()


def test_near_dedup_and_leaks_against_brute_force(steps, spark):
    lines, near, clean = steps[2], steps[3], steps[4]
    want = {i for i, _, top in brute_near(list(zip(lines.doc_id, lines.text, strict=True)), 5, 80) if i == top}
    assert set(near.doc_id) == want
    items = [t.lower().split() for t in spark.read.parquet(f"{SF}/benchmark.parquet").toPandas().text]
    grams = {tuple(w[i:i + 13]) for w in items for i in range(len(w) - 12)}
    for t in clean.text:
        w = t.lower().split()
        assert not any(tuple(w[i:i + 13]) in grams for i in range(len(w) - 12))


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in p.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
