"""Plain versions of the operators, for small tables only."""

import re

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(WORD, text or "")


def shingles(text, width=5):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) >= width:
        return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    return frozenset([tuple(w)] if w else [])


def near_components(rows):
    """doc_id -> (set size, smallest linked doc_id), by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    items = [(i, s) for i, s in sets.items() if s]
    for a, (i, x) in enumerate(items):
        for j, y in items[:a]:
            if 100 * len(x & y) >= 75 * len(x | y):
                u, v = sorted((find(i), find(j)))
                parent[v] = u
    return {i: (len(s), find(i)) for i, s in sets.items()}
