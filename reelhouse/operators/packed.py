"""Sorted lists of distinct positive numbers as bytes.

A list is the number of bits of its largest step, as one byte, then all its
steps (the first from 0) in so many bits each. Steps are never 0, so that
the zeros that fill up the last byte are none.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Numbers packed at once; their bits take a byte each.
_AT_ONCE = 1 << 20


def _starts(times: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(times)])[:-1]


def _runs(offsets: np.ndarray):
    """Runs of whole lists of about ``_AT_ONCE`` numbers."""
    i = 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _AT_ONCE, "right")) - 1)
        yield i, j
        i = j


def pack(numbers: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary for each list ``numbers[offsets[i]:offsets[i + 1]]``, none of them empty."""
    parts = []
    for i, j in _runs(offsets):
        some, times = numbers[offsets[i]:offsets[j]].astype(np.int64), np.diff(offsets[i:j + 1])
        step, first = np.diff(some, prepend=0), _starts(times)
        step[first] = some[first]
        parts.append(_pack(step, times))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def pack_steps(steps: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The same of lists of positive numbers in any order."""
    parts = [_pack(steps[offsets[i]:offsets[j]].astype(np.int64), np.diff(offsets[i:j + 1])) for i, j in _runs(offsets)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def _pack(step: np.ndarray, times: np.ndarray) -> pa.Array:
    first = _starts(times)
    width = np.frexp(np.maximum.reduceat(step, first).astype(np.float64))[1].astype(np.int64)
    size = 1 + (width * times + 7) // 8
    start = _starts(size)
    wide = np.repeat(width, times)
    place = np.repeat((start + 1) * 8, times) + (np.arange(len(step)) - np.repeat(first, times)) * wide
    bits = np.zeros(int(size.sum()) * 8, np.uint8)
    for b in range(int(width.max())):
        some = wide > b
        bits[place[some] + b] = (step[some] >> b) & 1
    data = np.packbits(bits, bitorder="little")
    data[start] = width
    offsets = np.append(start, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(times), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpack(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists, and how many each has."""
    step, times = unpack_steps(lists)
    total, first = np.cumsum(step), _starts(times)
    return total - np.repeat(total[first] - step[first], times) if len(step) else step, times


def unpack_steps(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same of ``pack_steps``."""
    offsets = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset:lists.offset + len(lists) + 1].astype(np.int64)
    if not len(lists):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(lists.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    start = offsets[:-1] - offsets[0]
    width = data[start].astype(np.int64)
    times = (np.diff(offsets) - 1) * 8 // width
    first = _starts(times)
    wide = np.repeat(width, times)
    place = np.repeat((start + 1) * 8, times) + (np.arange(len(wide)) - np.repeat(first, times)) * wide
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))       # the eight bytes from each byte on
    step = (words[place >> 3] >> (place & 7).astype(np.uint64)) & ((np.uint64(1) << wide.astype(np.uint64)) - np.uint64(1))
    step = step.astype(np.int64)
    real = step != 0
    return step[real], np.add.reduceat(real, first, dtype=np.int64)
