"""Plain definitions of the contracts, for small inputs."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict


def words(text):
    return (text or "").encode().split()


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def groups(nodes, links):
    """Smallest node reachable from each."""
    name = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(name[a], name[b])
            if name[a] != low or name[b] != low:
                name[a] = name[b] = low
                changed = True
    return name


def substring(docs, width):
    """(id, n_words, n_removed, kept) of rows (id, text)."""
    count = Counter()
    for _, text in docs:
        w = words(text)
        count.update(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    out = []
    for key, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - width + 1):
            if count[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((key, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def lines(docs, min_chars=20, min_docs=3):
    """(id, n_lines, n_dropped, kept) of rows (id, text)."""
    where = defaultdict(set)
    key = lambda x: x.strip().lower()
    split = [(i, (t or "").encode().split(b"\n")) for i, t in docs]
    for i, parts in split:
        for x in parts:
            if len(key(x).decode()) >= min_chars and i is not None:
                where[key(x)].add(i)
    out = []
    for i, parts in split:
        kept = [
            x for x in parts
            if i is None or len(where.get(key(x), ())) < min_docs or max(where[key(x)]) == i
        ]
        out.append((i, len(parts), len(parts) - len(kept), b"\n".join(kept).decode()))
    return out


def jaccard(docs, n, percent):
    """{id: (n_shingles, component)} of rows (id, text) with different ids."""
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    name = groups(sets, links)
    return {i: (len(sets[i]), name[i]) for i in sets}


def cosine_links(rows, threshold):
    """{id: (n_links, component)} of rows (id, vector, label) with different ids."""
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(x, y):
        return sum(a * b for a, b in zip(x, y)) / math.sqrt(sum(a * a for a in x) * sum(b * b for b in y))

    links = [
        (a, b)
        for a, x, p in rows for b, y, q in rows
        if a < b and p is not None and p == q and good(x) and good(y) and len(x) == len(y)
        and cosine(x, y) >= threshold
    ]
    name = groups([r[0] for r in rows], links)
    many = Counter(x for link in links for x in link)
    return {r[0]: (many[r[0]], name[r[0]]) for r in rows}
