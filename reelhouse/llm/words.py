"""Word hashes of whole text columns, computed on the UTF-8 bytes with numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A word's 64-bit hash
is a sum of random byte values times random position values, finalised with
its length, so it does not depend on the batch, the task or the process.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from reelhouse.llm.common import GOLDEN, golden, mix64

#: Bytes of text handled at once; the arrays made are about 40 times that.
CHUNK = 1 << 20

_SEP = np.zeros(256, bool)
_SEP[[32, 9, 10, 11, 12, 13]] = True
_low = np.arange(256)
_low[65:91] += 32
_BYTE = mix64((_low.astype(np.uint64) + np.uint64(1)) * GOLDEN)
_place = np.zeros(0, np.uint64)


def _places(n: int) -> np.ndarray:
    global _place
    if len(_place) < n:
        _place = mix64((np.arange(max(n, 256), dtype=np.uint64) + np.uint64(1000)) * GOLDEN) | np.uint64(1)
    return _place


def _hash(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first bytes, last bytes + 1 of the words of ``buf``; ``starts``
    are places where a word must begin anew (first bytes of texts)."""
    at = np.flatnonzero(~_SEP[buf])
    if not len(at):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    first = np.empty(len(at), bool)
    first[0] = True
    np.not_equal(at[1:], at[:-1] + 1, out=first[1:])
    mark = np.searchsorted(at, starts)
    first[mark[mark < len(at)]] = True
    s = np.flatnonzero(first)
    length = np.diff(np.append(s, len(at)))
    off = np.arange(len(at)) - np.repeat(s, length)
    h = np.add.reduceat(_BYTE[buf[at]] * _places(int(length.max()))[off], s)
    return mix64(h + length.astype(np.uint64) * GOLDEN), at[s], at[s] + length, length


def word_hashes(column: pa.Array, spans: bool = False) -> Iterator[tuple]:
    """Yields (first row, number of rows, row of each word counted from the
    first, hash of each word[, first byte, byte after the last]) for runs of
    rows; a text longer than ``CHUNK`` comes alone and is hashed in pieces cut
    at white space."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1
        j = min(max(j, i + 1), n)
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= CHUNK:
            h, a, b, _ = _hash(buf[lo:hi], offsets[i:j] - lo)
            rows = np.searchsorted(offsets[i:j + 1] - lo, a, "right") - 1
        else:
            parts, at = [], lo
            while at < hi:
                cut = min(at + CHUNK, hi)
                while cut < hi and not _SEP[buf[cut]]:
                    cut += 1
                ph, pa_, pb, _ = _hash(buf[at:cut], np.zeros(1, np.int64))
                parts.append((ph, pa_ + (at - lo), pb + (at - lo)))
                at = cut
            h, a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
            rows = np.zeros(len(h), np.int64)
        yield (i, j - i, rows, h, a + lo, b + lo, buf) if spans else (i, j - i, rows, h)
        i = j


def shingles(rows: np.ndarray, hashes: np.ndarray, n_rows: int, k: int) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each row. A row with fewer
    words has its whole sequence as one shingle; one without words has none."""
    out = []
    ends = np.searchsorted(rows, np.arange(n_rows + 1))
    weights = _places(k + 1)
    n = len(hashes)
    if n >= k:
        whole = np.zeros(n - k + 1, np.uint64)
        for p in range(k):
            whole += mix64(hashes[p:n - k + 1 + p] + golden(p)) * weights[p]
        whole = mix64(whole)
    for r in range(n_rows):
        a, b = int(ends[r]), int(ends[r + 1])
        if b - a >= k:
            out.append(np.unique(whole[a:b - k + 1]))
        elif b > a:
            short = hashes[a:b]
            x = np.zeros(1, np.uint64)
            for p in range(b - a):
                x += mix64(short[p:p + 1] + golden(p)) * weights[p]
            out.append(mix64(x + golden(b - a + 7)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
