"""Plain Python counterparts of the operators, quadratic where that is simplest."""

from __future__ import annotations

import hashlib
import re


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, width):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


def component_of(nodes, links):
    """node -> smallest node reachable."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicate_components(docs, width, percent):
    sets = {i: shingles(t, width) for i, t in docs.items()}
    ids = sorted(docs)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return component_of(ids, links), {i: len(s) for i, s in sets.items()}


def line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def dedup_lines(docs, min_chars=20, min_docs=3):
    """doc id -> (lines, dropped, kept text)."""
    holders = {}
    for i, text in docs.items():
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= min_chars:
                holders.setdefault(line_key(line), set()).add(i)
    result = {}
    for i, text in docs.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(line_key(x), ())) < min_docs or max(holders[line_key(x)]) == i]
        result[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return result


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def least_padding(histogram, buckets):
    """By trying all boundaries, for small histograms."""
    from itertools import combinations

    lengths = sorted(histogram)
    best = None
    for k in range(min(buckets, len(lengths))):
        for inner in combinations(lengths[:-1], k):
            bounds = [*inner, lengths[-1]]
            cost = sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())
            best = cost if best is None else min(best, cost)
    return best
