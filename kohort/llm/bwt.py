"""Burrows-Wheeler transform of a collection of short strings, column by column.

Round ``r`` inserts the suffix of length ``r`` of every string at once: its
place follows from the places of the suffixes of length ``r - 1`` (LF
mapping), and the longest common prefixes of the new suffixes and of their
successors follow from minima over the old ones.
"""

from __future__ import annotations

import numpy as np


def collection_bwt(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(lcp, string, length)`` of all sorted suffixes, and the transform itself.

    Suffixes end with a marker of their string that is smaller than any
    byte; markers are ordered as the strings are, and are no part of a
    common prefix.  ``lcp[i]`` is that of suffixes ``i - 1`` and ``i``.
    Symbol 0 of the transform stands for the start of a string.
    """
    m = len(strings)
    sizes = np.array([len(s) for s in strings])
    longest = int(sizes.max(initial=0))
    flat = np.frombuffer(b"".join(strings), np.uint8)
    used = np.flatnonzero(np.bincount(flat, minlength=256))
    kind = np.uint8 if len(used) < 256 else np.uint16
    dense = np.zeros(256, kind)
    dense[used] = np.arange(1, len(used) + 1)
    ends = np.cumsum(sizes)
    column = np.zeros((longest + 1, m), kind)  # column r: the symbol before the suffix of length r
    for r in range(longest):
        some = np.flatnonzero(sizes > r)
        column[r, some] = dense[flat[ends[some] - 1 - r]]

    bwt, lcp = column[0].copy(), np.zeros(m, np.uint16)
    who, at = np.arange(m), np.arange(m)
    for r in range(1, longest + 1):
        more = sizes[who] >= r
        who, at = who[more], at[more]
        shift = len(who)  # the other strings are whole: their symbols are 0
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(len(bwt), np.int32)
        rank[order] = np.arange(len(bwt), dtype=np.int32)
        q = rank[at].astype(np.int64)
        at = q + shift
        # common prefixes of the new suffixes and of their successors
        touched = np.zeros(len(bwt) + 1, bool)
        touched[q] = True
        touched[q + 1] = True
        touched = np.flatnonzero(touched[:-1])
        here, prev = order[touched], order[touched - 1]
        same = (touched > 0) & (bwt[here] == bwt[prev])
        value = np.zeros(len(touched), np.uint16)
        if same.any():
            lo, hi = prev[same] + 1, here[same] + 1
            down = np.argsort(-lo)  # so that reduceat does no work between the ranges
            limits = np.column_stack([lo[down], hi[down]]).ravel()
            least = np.minimum.reduceat(np.append(lcp, np.uint16(0)), limits)[::2]
            back = np.empty(len(down), np.uint16)
            back[down] = least
            value[same] = back + 1
        # sequential merge of the old and the new symbols
        new = np.zeros(len(bwt) + len(at), bool)
        new[at] = True
        by_place = np.argsort(at)
        old = ~new
        merged = np.empty(len(new), kind)
        merged[new] = column[r, who[by_place]]
        merged[old] = bwt
        common = np.zeros(len(new), np.uint16)
        common[old] = lcp
        common[touched + shift] = value
        bwt, lcp = merged, common

    order = np.argsort(bwt, kind="stable")
    rank = np.empty(len(bwt), np.int64)
    rank[order] = np.arange(len(bwt))
    string, length = np.empty(len(bwt), np.int32), np.empty(len(bwt), np.int32)
    who, at = np.arange(m), np.arange(m)
    for r in range(longest + 1):
        string[at], length[at] = who, r
        more = sizes[who] > r
        who, at = who[more], rank[at[more]]  # m strings start: m symbols are 0
    return lcp, string, length, bwt


def repeated(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``width`` bytes: (class, string, offset); equal windows have the same class."""
    lcp, string, length, _ = collection_bwt(strings)
    group = np.cumsum(lcp < width)
    whole = length >= width
    sizes = np.array([len(s) for s in strings])
    return group[whole], string[whole], sizes[string[whole]] - length[whole]
