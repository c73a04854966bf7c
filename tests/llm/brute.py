"""Brute-force versions on whole small tables."""

import re
from collections import Counter, defaultdict


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def near(rows, percent=85):
    """doc_id -> (set size, smallest reachable doc_id) of (doc_id, text) rows."""
    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    having = defaultdict(list)
    for i, (_, own) in enumerate(sets):
        for shingle in own:
            having[shingle].append(i)
    common = Counter()
    for found in having.values():
        common.update((a, b) for i, b in enumerate(found) for a in found[:i])
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a][1]) + len(sets[b][1]) - n):
            parent[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return {doc_id: (len(own), least[root(i)]) for i, (doc_id, own) in enumerate(sets)}


def contained(docs, items, least=0.8):
    """(doc_id, item_id) -> containment; an item of one to four words is one shingle of that many words."""
    sets = [(item_id, shingles(text)) for item_id, text in items]
    lengths = {len(shingle) for _, item in sets for shingle in item} | {5}
    found = {}
    for doc_id, text in docs:
        own = frozenset(s for n in lengths for s in shingles(text, n) if len(s) == n)
        for item_id, item in sets:
            if item and len(item & own) >= least * len(item):
                found[doc_id, item_id] = len(item & own) / len(item)
    return found
