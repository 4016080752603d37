"""The definitions of the measures, spelled out over Python lists for small graphs."""

from __future__ import annotations

import math
from collections import Counter


def common_neighbors(rows):
    edges = set(rows)
    found = Counter()
    for k, x in rows:
        for j, y in rows:
            if k == j and x < y and (x, y) not in edges:
                found[x, y] += 1
    return dict(found)


def adamic_adar(rows):
    edges, degree = set(rows), Counter(k for k, _ in rows)
    found = Counter()
    for k, x in rows:
        for j, y in rows:
            if k == j and x < y and (x, y) not in edges:
                found[x, y] += 1 / math.log10(degree[k])
    return dict(found)


def jaccard(rows):
    edges, degree = set(rows), Counter(k for k, _ in rows)
    totals = {}
    for x, y in {(x, y) for k, x in rows for j, y in rows if k == j and x != y}:
        if (x, y) not in edges and degree[x]:
            pair = min(x, y), max(x, y)
            totals[pair] = totals.get(pair, 0) + degree[x]
    scores = {}
    for pair, shared in common_neighbors(rows).items():
        if pair in totals:
            union = totals[pair] - shared
            scores[pair] = shared / union if union else math.inf
    return scores


def best(scores, k):
    return sorted(((u, v, s) for (u, v), s in scores.items()), key=lambda r: (-r[2], r[0], r[1]))[:k]
