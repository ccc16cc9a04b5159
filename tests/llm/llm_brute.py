"""Plain versions of the operators, for comparison."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


class Union(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def tie(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self[max(a, b)] = min(a, b)


def shingle_set(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))


def ngram_components(docs):
    """{doc_id: (set size, component)} for rows (doc_id, text) with unique ids."""
    sets = {i: shingle_set(t) for i, t in docs}
    union, owners = Union(), {}
    for i, s in sets.items():
        union.find(i)
        for x in s:
            owners.setdefault(x, []).append(i)
    for i, s in sets.items():
        for j, v in Counter(j for x in s for j in owners[x] if j > i).items():
            if 100 * v >= 75 * (len(s) + len(sets[j]) - v):
                union.tie(i, j)
    return {i: (len(s), union.find(i)) for i, s in sets.items()}


def near_vectors(rows, cosine=0.98):
    """{vec_id: (links, component)} for rows (vec_id, vector, label) with unique ids."""
    union, links = Union(), Counter()
    ok = []
    for i, v, label in rows:
        union.find(i)
        if label is None or v is None or any(x is None for x in v):
            continue
        x = np.array(v, np.float32).astype(float)
        if len(x) and np.isfinite(x).all() and x.any():
            ok.append((i, x, label))
    for k, (i, x, a) in enumerate(ok):
        for j, y, b in ok[k + 1 :]:
            if a == b and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= cosine:
                union.tie(i, j)
                links[i] += 1
                links[j] += 1
    return {i: (links[i], union.find(i)) for i, _, _ in rows}


def contaminations(docs, items, share=75):
    """(doc_id, item_id) -> (shingles of the item, those the document holds)."""

    def words(text):
        return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]

    def grams(w, n):
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}

    out = {}
    for item_id, item in items:
        n = min(5, len(words(item)))
        own = grams(words(item), n) if n else set()
        for doc_id, text in docs:
            both = len(own & grams(words(text), n)) if n else 0
            if own and both * 100 >= len(own) * share:
                out[doc_id, item_id] = (len(own), both)
    return out
