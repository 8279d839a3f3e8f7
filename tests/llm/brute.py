"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORDS = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def groups(names, links):
    parent = {n: n for n in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in names}


def shingles(text, width=5):
    w = WORDS.findall(lower(text))
    if len(w) >= width:
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
    return {tuple(w)} if w else set()


def near(texts, share=75):
    """{id: (set size, component, kept)}"""
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    links = [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[:n]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])
    ]
    root = groups(ids, links)
    return {i: (len(sets[i]), root[i], root[i] == i) for i in ids}


def repeats(texts, length):
    """[(bytes, removed, spans, sha256 of the rest)]"""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        rest = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out
