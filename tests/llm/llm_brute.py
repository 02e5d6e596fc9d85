"""Plain re-statements of the operators' results, one row at a time, for small tables."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingles(text, size=5):
    found = words((text or "").translate(LOWER))
    if not found:
        return set()
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))}


def classes(n, links):
    """Smallest index each index is connected to."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(x) for x in range(n)]


def near_duplicates(rows, size=5, percent=80):
    """rows: (doc_id, text). The smallest doc_id of each row's component."""
    sets = [shingles(text, size) for _, text in rows]
    holders = {}
    for i, found in enumerate(sets):
        for shingle in found:
            holders.setdefault(shingle, []).append(i)
    pairs = {(h[0], x) for h in holders.values() for x in h} | {
        (a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1 :]
    }
    links = [
        (a, b) for a, b in pairs
        if a != b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    of = classes(len(rows), links)
    lowest = {}
    for i, c in enumerate(of):
        doc_id = rows[i][0]
        if doc_id is not None:
            lowest[c] = min(doc_id, lowest.get(c, doc_id))
    return [(rows[i][0], len(sets[i]), lowest.get(of[i])) for i in range(len(rows))]
