"""Plain counterparts of the operators, for small tables in memory."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return [w for w in BLANK.split(text or "") if w]


def components(nodes, edges) -> dict:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text: str | None, length: int = 2) -> frozenset:
    w = words(ascii_lower(text or ""))
    if len(w) < length:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*(w[i:] for i in range(length)), strict=False))


def near_documents(rows, length: int = 2) -> dict[int, tuple[int, int, bool]]:
    """doc_id -> (n_shingles, component_id, kept)."""
    sets = {i: shingle_set(t) if length == 2 else shingle_set(t, length) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = Counter()
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a + 1, len(ids)):
                common[ids[a], ids[b]] += 1
    edges = [(a, b) for (a, b), n in common.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    found = components(sets, edges)
    return {i: (len(sets[i]), found[i], found[i] == i) for i in sets}


def near_vectors(rows, threshold=0.93) -> dict[int, tuple[int, int, bool]]:
    """vec_id -> (n_links, component_id, kept)."""
    groups = defaultdict(list)
    for i, v, label in rows:
        if label is None or v is None or not len(v) or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        groups[label, len(v)].append((i, np.asarray(v, float) / np.linalg.norm(np.asarray(v, float))))
    links, edges = Counter(), []
    for members in groups.values():
        ids = [i for i, _ in members]
        cosine = np.array([v for _, v in members]) @ np.array([v for _, v in members]).T
        for a, b in zip(*np.where(np.triu(cosine, 1) >= threshold), strict=True):
            links[ids[a]] += 1
            links[ids[b]] += 1
            edges.append((ids[a], ids[b]))
    found = components([i for i, _, _ in rows], edges)
    return {i: (links[i], found[i], found[i] == i) for i, _, _ in rows}


def source_targets(sizes: dict[str | None, int], weights=(5, 2, 1), share=1.5, limit=2.0) -> dict[str | None, float]:
    """Shares by weight; what lies above a source's cap is shared again among the others."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, open_ = share * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        rest = 0.0
        for s in sorted(open_, key=order.index):
            target[s] += left * weight[s] / total
        for s in list(open_):
            if target[s] >= limit * sizes[s]:
                rest += target[s] - limit * sizes[s]
                target[s] = limit * sizes[s]
                open_.remove(s)
        left = rest
    return target


def remainder(doc_id, divisor: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % divisor


def token_counts(rows, divisor=5, held=1):
    """Per document (n_tokens, n_known, train_tokens, base_score)."""
    lists = [(i, [*words(ascii_lower(t or "")), ""]) for i, t in rows]
    counts = Counter()
    for i, tokens in lists:
        if remainder(i, divisor) != held:
            counts.update(tokens)
    total, distinct = sum(counts.values()), len(counts)
    base = lambda w: math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1)))
    return [(i, len(t), sum(counts[w] > 0 for w in t), total, math.fsum(base(w) for w in t)) for i, t in lists]
