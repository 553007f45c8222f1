"""Brute-force forms that several tests share."""
import itertools

from reelhouse.llm.components import union_find


def low(text):
    return (text or "").encode().lower()


def brute_near(rows, k, percent):
    def shingles(t):
        w = low(t).split()
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(a, b) for (a, x), (b, y) in itertools.combinations([s for s in sets if s[0] is not None], 2)
             if x and y and 100 * len(x & y) >= percent * len(x | y)]
    top = union_find(links)
    return {(i, len(s), None if i is None else top.get(i, i)) for i, s in sets}
