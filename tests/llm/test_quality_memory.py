"""The quality classifier gathers word vectors in bounded pieces."""
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from reelhouse.llm import op4_quality as q


def _texts(rows, words, seed=5):
    rng = np.random.default_rng(seed)
    return pa.array([" ".join(f"w{x}" for x in rng.integers(0, 1 << 20, words)) for _ in range(rows)])


def _peak_mb(run):
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("rows, words", [(60, 2000), (1, 120_000)])
def test_memory_of_neighbours_and_pooling_is_bounded(rows, words):
    column = _texts(rows, words)
    assert 0.8 * (1 << 20) < sum(len(x.as_py()) for x in column) <= 1 << 20     # one run of texts
    batch = pa.RecordBatch.from_arrays([column], names=["_llm_text"])
    assert _peak_mb(lambda: list(q._neighbours(iter([batch]))))[1] < 120
    vectors = q.index_vectors().astype(np.float32)
    assert _peak_mb(lambda: q.pooled(column, vectors))[1] < 120


def test_pieces_give_what_one_piece_gives(monkeypatch):
    column = pa.concat_arrays([_texts(40, 50), pa.array([None, "", "one", "Two two, two."]), _texts(3, 3000)])
    batch = pa.RecordBatch.from_arrays([column], names=["_llm_text"])
    vectors = q.index_vectors().astype(np.float32)
    got = []
    for size in (1, 97, q.GATHER, 1 << 30):
        monkeypatch.setattr(q, "GATHER", size)
        got.append((q.pooled(column, vectors), [b.to_pydict() for b in q._neighbours(iter([batch]))]))
    for x, sums in got[1:]:
        assert np.array_equal(x, got[0][0]) and sums == got[0][1]
