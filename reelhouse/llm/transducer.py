"""Minimal acyclic transducer: sorted terms to their lexicographic ordinals and back.

States with equal continuations are one state. An arc carries how many terms
come before those that go on through it, so the sum along a term's path is the
term's place in the sorted list.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np


@dataclass
class Transducer:
    root: int
    n: int
    keys: np.ndarray       # state * 256 + byte, ascending
    targets: np.ndarray
    before: np.ndarray     # terms before those through the arc
    final: np.ndarray

    @classmethod
    def build(cls, terms: Iterable[bytes]) -> "Transducer":
        """From distinct terms in ascending byte order, one pass: what cannot
        change any more is merged with an equal state at once."""
        register: dict = {}
        keys: list[int] = []
        targets: list[int] = []
        before: list[int] = []
        final: list[bool] = []
        sizes: list[int] = []

        def settle(node) -> int:
            signature = (node[0], tuple(node[1]), tuple(node[2]))
            state = register.get(signature)
            if state is None:
                state = register[signature] = len(final)
                count = int(node[0])
                for label, target in zip(node[1], node[2], strict=True):
                    keys.append(state * 256 + label)
                    targets.append(target)
                    before.append(count)
                    count += sizes[target]
                final.append(node[0])
                sizes.append(count)
            return state

        path = [[False, [], []]]
        last = b""
        for term in terms:
            k, most = 0, min(len(last), len(term))
            while k < most and last[k] == term[k]:
                k += 1
            while len(path) > k + 1:
                state = settle(path.pop())
                path[-1][2].append(state)
            for label in term[k:]:
                path[-1][1].append(label)
                path.append([False, [], []])
            path[-1][0] = True
            last = term
        while len(path) > 1:
            state = settle(path.pop())
            path[-1][2].append(state)
        root = settle(path[0])
        return cls(root, sizes[root], np.array(keys, np.int64), np.array(targets, np.int64),
                   np.array(before, np.int64), np.array(final, bool))

    def to_bytes(self) -> bytes:
        head = np.array([self.root, self.n, len(self.keys), len(self.final)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.keys, self.targets.astype(np.int32), self.before, self.final))

    @classmethod
    def from_bytes(cls, data: bytes) -> "Transducer":
        root, n, arcs, states = np.frombuffer(data, np.int64, 4).tolist()
        at = 32
        parts = []
        for kind, count in ((np.int64, arcs), (np.int32, arcs), (np.int64, arcs), (np.bool_, states)):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        return cls(root, n, parts[0], parts[1].astype(np.int64), parts[2], parts[3])

    def ordinals(self, terms: list[bytes]) -> np.ndarray:
        """Place of each term in the sorted list, -1 for others. All terms go
        through the states together, one byte a step."""
        size = np.fromiter(map(len, terms), np.int64, len(terms))
        buf = np.frombuffer(b"".join(terms), np.uint8)
        start = np.cumsum(size) - size
        out = np.full(len(terms), -1, np.int64)
        live = np.arange(len(terms))
        state, total = np.full(len(terms), self.root), np.zeros(len(terms), np.int64)
        step = 0
        while len(live):
            ended = size[live] == step
            if ended.any():
                done = ended & self.final[state]
                out[live[done]] = total[done]
                live, state, total = live[~ended], state[~ended], total[~ended]
                if not len(live):
                    break
            if not len(self.keys):
                break
            want = state * 256 + buf[start[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            ok = self.keys[arc] == want
            live, arc, total = live[ok], arc[ok], total[ok]
            state, total = self.targets[arc], total + self.before[arc]
            step += 1
        return out

    def terms(self) -> Iterator[bytes]:
        """All terms in order."""
        first = np.searchsorted(self.keys, np.arange(len(self.final) + 1) * 256).tolist()
        labels, targets = (self.keys % 256).tolist(), self.targets.tolist()
        prefix = bytearray()
        if self.final[self.root]:
            yield b""
        stack = [iter(range(first[self.root], first[self.root + 1]))]
        while stack:
            arc = next(stack[-1], None)
            if arc is None:
                stack.pop()
                if prefix:
                    prefix.pop()
                continue
            prefix.append(labels[arc])
            state = targets[arc]
            if self.final[state]:
                yield bytes(prefix)
            stack.append(iter(range(first[state], first[state + 1])))
