"""Plain versions of the contracts, for comparison on small tables."""

import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def connected(n, linked):
    """Component (smallest index) of each of n items; linked(i) gives the partners of item i."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(n):
        for j in linked(i):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_dedup(rows, radius=3):
    """{doc_id: (fingerprint, component_id)} of (doc_id, text) rows."""
    prints = [fingerprint(t) for _, t in rows]
    parts = connected(len(rows), lambda i: [j for j in range(len(rows)) if bin(prints[i] ^ prints[j]).count("1") <= radius])
    least = {}
    for (k, _), p in zip(rows, parts):
        if k is not None:
            least[p] = min(k, least.get(p, k))
    return [(k, f"{f:016x}", least.get(p)) for (k, _), f, p in zip(rows, prints, parts)]


def vector_dedup(rows, threshold=0.9):
    """(vec_id, n_links, component_id, kept) of (vec_id, vector) rows."""

    def valid(k, v):
        return k is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    ok = [i for i, (k, v) in enumerate(rows) if valid(k, v)]
    links = {i: [] for i in range(len(rows))}
    for a in ok:
        for b in ok:
            x, y = np.array(rows[a][1], dtype=float), np.array(rows[b][1], dtype=float)
            if a != b and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                links[a].append(b)
    parts = connected(len(rows), links.get)
    least = {}
    for i in ok:
        least[parts[i]] = min(rows[i][0], least.get(parts[i], rows[i][0]))
    return [(k, len(links[i]), least.get(parts[i], k), least.get(parts[i], k) == k) for i, (k, _) in enumerate(rows)]


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered), n < 50 or 100 * len(covered) > 50 * n
