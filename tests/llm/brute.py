"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def shingle_set(text, words=4):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < words else [tuple(w[i:i + words]) for i in range(len(w) - words + 1)])


def components(rows, percent=85):
    """doc_id -> (set size, component) for (doc_id, text) with distinct ids."""
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {d: (len(sets[d]), root(d)) for d in ids}


def cut(rows, width=100):
    """doc_id -> (bytes, removed, runs, kept) for (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            w = data[i:i + width]
            if w in seen:
                gone[i:i + width] = b"\1" * width
            else:
                seen.add(w)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g))
    return out


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    where: dict[tuple, list[int]] = {}
    for i in range(len(w) - 2):
        where.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(3)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
