"""Scores of titles by the neighbours that have them, at the user."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .packed import pack, unpack

#: Titles of neighbours that a task adds up at once.
ENTRIES = 1 << 21
_TITLE = np.int64((1 << 40) - 1)


def packed_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (user_id, titles) with the titles' numbers, from 1 on, as a packed list."""
    for batch in batches:
        titles = batch.column("titles")
        offsets = titles.offsets.to_numpy()
        row = np.repeat(np.arange(len(titles)), np.diff(offsets))
        number = titles.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("user_id"), pack(number[np.lexsort((number, row))], offsets - offsets[0])],
                                         names=["user_id", "titles"])


def _added(key, score, times, seen) -> list[np.ndarray]:
    """Sums by key, sorted."""
    if not len(key):
        return [key, score, times, seen]
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return [key[at], *[np.add.reduceat(x[order], at) for x in (score, times, seen)]]


def _best(users: np.ndarray, key, score, times, seen, n: int) -> pa.RecordBatch:
    """A row a user with its best ``n`` unseen titles, and those that may take their place after rounding to 9 decimals."""
    open_ = (seen == 0) & (times > 0)
    key, score, times = (x[open_] for x in (key, score, times))
    group, title = key >> 40, key & _TITLE
    order = np.lexsort((title, -np.round(score, 9), group))
    group, title, score, times = (x[order] for x in (group, title, score, times))
    first = np.searchsorted(group, np.arange(len(users)))
    size = np.diff(np.append(first, len(group)))
    place = np.arange(len(group)) - np.repeat(first, size)
    off = np.abs(score - np.repeat(score[np.minimum(first + np.minimum(size, n) - 1, len(score) - 1)], size)) if len(score) else score
    keep = (place < n) | ((off <= 2e-9) & (off > 1e-14))
    offsets = np.concatenate([[0], np.cumsum(keep)])[np.append(first, len(keep))]
    best = pa.StructArray.from_arrays([pa.array(x[keep]) for x in (title, score, times)], names=["title", "score", "n"])
    return pa.RecordBatch.from_arrays([pa.array(users, pa.string()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), best)],
                                      names=["user_id", "best"])


def best_titles(n: int, none: int):
    """Of rows (user_id, similarity, titles) sorted by user, a null similarity marking what the user has seen: sums of the
    similarities a title. Numbers up to ``none`` are never seen."""
    def run(batches):
        held, entries = [], 0
        rest = None         # the sums so far of the last user, who may go on

        def flush(all_: bool):
            nonlocal held, entries, rest
            users = np.concatenate([h[0] for h in held])
            new = np.concatenate([[True], users[1:] != users[:-1]])
            group = np.repeat(np.cumsum(new) - 1, np.concatenate([h[1] for h in held]))
            title, score, times, seen = (np.concatenate([h[c] for h in held]) for c in (2, 3, 4, 5))
            x, users = _added((group << 40) | title, score, times, seen), users[new]
            if rest is not None:
                if rest[0][0] == users[0]:
                    x = _added(*[np.concatenate([a, b]) for a, b in zip(rest[1], x, strict=True)])
                else:
                    yield _best(*rest[:1], *rest[1], n)
            cut = len(x[0]) if all_ else int(np.searchsorted(x[0], np.int64(len(users) - 1) << 40))
            stop = len(users) if all_ else len(users) - 1
            if stop:
                yield _best(users[:stop], *[c[:cut] for c in x], n)
            rest = None if all_ else (users[-1:], [x[0][cut:] & _TITLE, *[c[cut:] for c in x[1:]]])
            held, entries = [], 0

        for batch in batches:
            title, many = unpack(batch.column("titles"))
            similarity = batch.column("similarity")
            own = np.repeat(similarity.is_null().to_numpy(zero_copy_only=False), many)
            score = np.repeat(similarity.fill_null(0).to_numpy(zero_copy_only=False), many)
            held.append((batch.column("user_id").to_numpy(zero_copy_only=False), many, title, score, (~own).astype(np.int64),
                         (own & (title > none)).astype(np.int64)))
            entries += len(title)
            if entries > ENTRIES:
                yield from flush(False)
        if held:
            yield from flush(True)
        elif rest is not None:
            yield _best(*rest[:1], *rest[1], n)
    return run
