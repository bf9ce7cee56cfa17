"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = (1 << 63) - 1


def components(nodes, links) -> dict:
    root = {n: n for n in nodes}

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def jump(key: int, shards: int) -> int:
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def shingle_set(text, k: int) -> set:
    words = (text or "").translate(LOWER).encode().split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def near_duplicates(texts: dict, k: int, percent: int) -> dict:
    """(set size, smallest id) per id."""
    sets = {i: shingle_set(t, k) for i, t in texts.items()}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    found = components(ids, links)
    return {i: (len(sets[i]), found[i]) for i in ids}


def near_vectors(rows, threshold: float) -> list:
    """(id, links, smallest id) per row of (id, vector, label)."""

    def good(v, label):
        return label is not None and v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v)

    n = len(rows)
    links = []
    for i in range(n):
        for j in range(i):
            (_, a, x), (_, b, y) = rows[i], rows[j]
            if good(a, x) and good(b, y) and x == y and len(a) == len(b):
                a, b = np.array(a, np.float64), np.array(b, np.float64)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links.append((i, j))
    count = [sum(i in link for link in links) for i in range(n)]
    found = components(range(n), links)
    least = {}
    for i in range(n):
        least[found[i]] = min(least.get(found[i], rows[i][0]), rows[i][0])
    return [(rows[i][0], count[i], least[found[i]]) for i in range(n)]


def remove_repeats(rows, window: int) -> list:
    """(id, words, removed, sha256 of what is left) per row of (id, text); rows of one id and text are one document."""
    seen, answers = {}, {}
    for i, text in sorted({(LAST if i is None else i, t or "") for i, t in rows}):
        words = text.encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in seen:
                gone[p : p + window] = [True] * window
            seen.setdefault(key, (i, p))
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        answers[i, text] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return [(i, *answers[LAST if i is None else i, t or ""]) for i, t in rows]


def kept_text(texts: dict, wanted: int, window: int = 20) -> str:
    """What ``remove_repeats`` leaves of one document among documents by id."""
    seen = set()
    for i in sorted(texts):
        words = (texts[i] or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in seen:
                gone[p : p + window] = [True] * window
            seen.add(key)
        if i == wanted:
            return b" ".join(w for w, g in zip(words, gone) if not g).decode()
    raise KeyError(wanted)
