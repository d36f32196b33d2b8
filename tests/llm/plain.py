"""Plain versions of the operators, for small inputs."""

import re
from itertools import combinations

UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def groups(nodes, linked):
    """Smallest reachable node of each node."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_groups(texts, percent=75):
    sets = {i: shingles(t) for i, t in texts.items()}
    linked = []
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                linked.append((a, b))
    return sets, groups(sets, linked)
