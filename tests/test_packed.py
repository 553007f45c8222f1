"""Packed lists give back what was packed, in few bytes."""
import numpy as np
import pyarrow as pa

from reelhouse.operators import packed


def test_packed_lists(monkeypatch):
    monkeypatch.setattr(packed, "_AT_ONCE", 1000)
    rng = np.random.default_rng(3)
    lists = [np.unique(rng.integers(1, top, n)) for top in (2, 9, 300, 10**7, 2**40) for n in (1, 2, 7, 30, 3000)]
    flat, offsets = np.concatenate(lists), np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    got = packed.pack(flat, offsets)
    numbers, times = packed.unpack(got)
    assert times.tolist() == [len(x) for x in lists] and numbers.tolist() == flat.tolist()
    numbers, times = packed.unpack(got.slice(3, 5))
    assert numbers.tolist() == np.concatenate(lists[3:8]).tolist() and len(times) == 5
    users = np.unique(rng.integers(1, 5_000_000, 1024))
    assert len(packed.pack(users, np.array([0, len(users)]))[0].as_py()) < 2.2 * len(users)
    assert len(packed.pack(flat[:0], np.zeros(1, np.int64))) == 0 and packed.unpack(pa.array([], pa.binary()))[0].size == 0
