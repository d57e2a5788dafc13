"""A random forest without a depth limit (M4, M7, M9).

A tree's upper nodes hold many rows and need the cluster; deep levels hold
many small nodes, which need no cluster-wide work.  So:

* **Top.**  While nodes hold more than ``node_rows`` rows, a round splits all
  of them, in all trees: tasks count their rows per node, feature and bin, the
  counts of a node meet in one task, which finds its best split.  The bins are
  quantiles of a hash-chosen sample; a node that they cannot split gets
  quantiles of its own rows.  Up to ``node_rows`` training rows, no round is
  needed; a forest so shallow that its nodes fit a round is finished by rounds.
* **Bottom.**  The drawn rows of a (tree, node) meet in one task, at most
  ``node_rows`` of them, and the whole subtree is grown there, one level of
  all its nodes at a time, on sorted arrays: exact thresholds, Gini, ``k``
  of the features that vary in the node, until nodes are pure.

Rows travel as blocks of arrays, one per batch, tree and node.  Every random
choice is a hash (bootstrap: seed, tree, key; features: seed, tree, node), so
the same rows give the same forest on any cluster.  The subtrees are a table,
one row per (tree, path), saved as Parquet.  Scoring sends a forest of at most
``BROADCAST_BYTES`` to the executors; beyond that blocks of rows meet shares
of the trees, every block every tree once.

Defined cases: NaN counts as larger than any number; rows that repeat a key
share a bootstrap count; equal gains go to the first feature, then to the
lowest threshold; a training set of one class gives trees of one leaf.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import shared_table

#: rows of a node from which on one task grows the rest of its tree
NODE_ROWS = 100_000
#: a forest up to this size is sent to every executor for scoring
BROADCAST_BYTES = 64 * 1024 * 1024
#: bins per feature, and rows whose quantiles bound them, in the top levels
BINS, _SAMPLE_ROWS = 64, 20_000
#: a forest of a depth limit with at most so many nodes is finished by rounds
_ROUND_NODES = 4096
#: bytes of trees and rows that meet in one task of a large forest's scoring
_TREES_BYTES, _BLOCKS_ROWS = 160 * 1024 * 1024, 1_500_000
_BATCH_ROWS = 10_000  # rows of a block of the rows to score
_NODE_BYTES = 32   # feature, threshold, two children, share
_ONE = float(1 << 20)  # the top counts weights in parts of this: sums do not depend on their order
_U = np.uint64
_SUBTREES = ("tree int, path string, feature array<int>, threshold array<double>, left array<int>, right array<int>, "
             "share array<double>, gain array<double>, weight array<double>")


def _mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (multiply and shift rounds)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def bootstrap_count(seed: int, tree: Column, key: Column) -> Column:
    """How often a row is drawn for a tree: Poisson(1), from a hash."""
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), tree, key), 11) / float(1 << 53)
    total, term, count = 0.0, math.exp(-1), F.lit(0)
    for k in range(1, 16):
        total += term
        term /= k
        count = count + F.when(u >= total, 1).otherwise(0)
    return count


# ------------------------------------------------------------------ one subtree
def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, seed: int, k: int, min_split: int = 2, min_leaf: int = 1,
         max_depth: int | None = None) -> dict[str, np.ndarray]:
    """Grow one tree on ``x`` (rows x features), 0/1 labels and weights, level by level.

    -> feature (-1: leaf), threshold (x <= threshold goes left), left, right
    (node numbers), share (of class 1), gain (weighted Gini decrease), weight.
    """
    x = np.where(np.isnan(x), np.inf, x)
    feature, threshold, left, right, share, gains, weight = [], [], [], [], [], [], []
    at, hashes, first, depth = np.zeros(len(x), np.int64), _mix(np.array([seed], np.uint64)), 0, 0
    rows = np.arange(len(x))
    place_of = [np.unique(v, return_inverse=True)[1].astype(np.int64) for v in x.T]
    while len(hashes):
        n, c = len(hashes), at[rows]
        if n > 1:
            order = np.argsort(c, kind="stable")
            rows, c = rows[order], c[order]
        start = np.searchsorted(c, np.arange(n))
        size = np.diff(np.append(start, len(c)))
        wr = w[rows]
        total, ones = np.bincount(c, wr, n), np.bincount(c, wr * y[rows], n)
        share.append(np.divide(ones, total, out=np.zeros(n), where=total > 0))
        weight.append(total)
        stop = (size < max(2, min_split)) | (ones <= 0) | (ones >= total) | (max_depth is not None and depth >= max_depth)
        node_f, node_t, node_g = _best_splits(x, y, w, place_of, rows, c, start, size, total, ones, hashes, k, min_leaf, ~stop)
        split = node_f >= 0
        kids = first + n + 2 * (np.cumsum(split) - 1)
        feature.append(node_f)
        threshold.append(np.where(split, node_t, 0.0))
        gains.append(np.where(split, node_g, 0.0))
        left.append(np.where(split, kids, -1))
        right.append(np.where(split, kids + 1, -1))
        go = split[c]
        rows, c = rows[go], c[go]
        goes_right = x[rows, node_f[c]] > node_t[c]
        at[rows] = 2 * (np.cumsum(split) - 1)[c] + goes_right
        h = hashes[split]
        hashes = np.stack([_mix(h * _U(2) + _U(1)), _mix(h * _U(2) + _U(2))], axis=1).ravel()
        first, depth = first + n, depth + 1
    join = np.concatenate
    return {"feature": join(feature).astype(np.int32), "threshold": join(threshold), "left": join(left).astype(np.int32),
            "right": join(right).astype(np.int32), "share": join(share), "gain": join(gains), "weight": join(weight)}


def _by_node_and_rank(node: np.ndarray, rank: np.ndarray, rows: int) -> np.ndarray:
    """The stable order by (node, rank): one sort of numbers that hold both and the position, if they fit."""
    places = max(1, (len(node) - 1).bit_length())
    ranks = max(1, (rows - 1).bit_length())
    if places + ranks + max(1, int(node[-1]).bit_length()) > 62:
        return np.lexsort((rank, node))
    key = (((node << ranks) | rank) << places) | np.arange(len(node))
    key.sort()
    return key & ((1 << places) - 1)


def _ranks(hashes: np.ndarray, features: int) -> np.ndarray:
    """The order number of each feature in each node, by a hash."""
    return _mix(hashes[:, None] ^ _mix(np.arange(1, features + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))) >> _U(1)


def _best_splits(x, y, w, place_of, rows, c, start, size, total, ones, hashes, k, min_leaf,
                 wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature (-1: none), threshold and gain of the best split of each ``wanted`` node.

    ``rows`` are sorted by node (``c``); nodes begin at ``start``; ``place_of``
    has the ranks of the values per feature.
    """
    n, features = len(start), x.shape[1]
    node_f, node_t, node_s = np.full(n, -1), np.zeros(n), np.full(n, -np.inf)
    here = x[rows]
    varies = np.minimum.reduceat(here, start, axis=0) < np.maximum.reduceat(here, start, axis=0)
    rank = np.where(varies, _ranks(hashes, features), _U(1 << 63))  # features that do not vary come last
    taken = np.zeros((n, features), bool)
    np.put_along_axis(taken, np.argsort(rank, axis=1, kind="stable")[:, :k], True, axis=1)
    taken &= varies & wanted[:, None]
    for f in range(features):
        pick = taken[c, f]
        if not pick.any():
            continue
        r, node = rows[pick], c[pick]
        v = x[r, f]
        order = _by_node_and_rank(node, place_of[f][r], len(x))  # node numbers are sorted already: their order stays
        r, v = r[order], v[order]
        wr = w[r]
        cw, c1 = np.cumsum(wr), np.cumsum(wr * y[r])
        begin = np.flatnonzero(np.diff(node, prepend=-1))
        long = np.diff(np.append(begin, len(node)))
        base_w, base_1 = np.repeat(cw[begin] - wr[begin], long), np.repeat(c1[begin] - (wr * y[r])[begin], long)
        place = np.arange(len(node)) - np.repeat(begin, long) + 1
        wl, l1 = cw - base_w, c1 - base_1
        wt, t1 = total[node], ones[node]
        edge = np.append((node[:-1] == node[1:]) & (v[:-1] < v[1:]), False)
        edge &= (place >= min_leaf) & (size[node] - place >= min_leaf)
        at = np.flatnonzero(edge)
        if not len(at):
            continue
        wl, l1, wt, t1, at_node = wl[at], l1[at], wt[at], t1[at], node[at]
        wr_, r1 = wt - wl, t1 - l1
        ok = (wl > 0) & (wr_ > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            s = np.where(ok, (l1 * l1 + (wl - l1) ** 2) / wl + (r1 * r1 + (wr_ - r1) ** 2) / wr_, -np.inf)
        groups = np.flatnonzero(np.diff(at_node, prepend=-1))
        top = np.maximum.reduceat(s, groups)
        hit = s == np.repeat(top, np.diff(np.append(groups, len(s))))
        firsts = np.flatnonzero(hit)
        firsts = firsts[np.unique(at_node[firsts], return_index=True)[1]]  # the lowest threshold
        where = at_node[firsts]
        better = (s[firsts] > node_s[where]) & np.isfinite(s[firsts])
        firsts, where = firsts[better], where[better]
        a, b = v[at[firsts]], v[at[firsts] + 1]
        with np.errstate(invalid="ignore", over="ignore"):
            mid = a + (b - a) / 2
        node_f[where], node_s[where] = f, s[firsts]
        node_t[where] = np.where(np.isfinite(mid) & (mid < b), mid, a)
    gain = np.where(node_f >= 0, node_s - (ones ** 2 + (total - ones) ** 2) / np.where(total > 0, total, 1), 0.0)
    return node_f, node_t, gain


def walk(x: np.ndarray, tree: dict[str, np.ndarray]) -> np.ndarray:
    """The share of class 1 in the leaf of each row."""
    x = np.where(np.isnan(x), np.inf, x)
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(rows):
        f = tree["feature"][at[rows]]
        rows, f = rows[f >= 0], f[f >= 0]
        here = at[rows]
        at[rows] = np.where(x[rows, f] <= tree["threshold"][here], tree["left"][here], tree["right"][here])
    return tree["share"][at]


def _matrix(column: pa.ChunkedArray | pa.ListArray) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    edge = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)[edge[0]:edge[-1]]
    return flat.reshape(len(lists), -1) if len(lists) else np.empty((0, 0))


# ------------------------------------------------------------------ the top levels
def _counts(hashes: np.ndarray) -> np.ndarray:
    """As :func:`bootstrap_count`, from the hashes."""
    total, term, bounds = 0.0, math.exp(-1), []
    for k in range(1, 16):
        total += term
        term /= k
        bounds.append(total)
    return np.searchsorted(bounds, (hashes.view(np.uint64) >> _U(11)) / float(1 << 53), side="right").astype(np.uint8)


def _with_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bootstrap hashes of a row's trees (last column) become one byte each."""
    for batch in batches:
        drawn = _counts(_matrix(batch.column(batch.num_columns - 1)))
        drawn = pa.array([r.tobytes() for r in drawn], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], drawn], [*batch.schema.names[:-1], "drawn"])


def _cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Thresholds per feature, at most ``bins`` - 1: between neighbouring values, or quantiles where these are more."""
    out = []
    for v in np.where(np.isnan(x), np.inf, x).T:
        each = np.unique(v)
        v = each if len(each) <= bins else np.unique(np.sort(v)[np.linspace(0, len(v) - 1, bins).astype(int)])
        a, b = v[:-1], v[1:]
        with np.errstate(invalid="ignore", over="ignore"):
            middle = a + (b - a) / 2
        out.append(np.where(np.isfinite(middle) & (middle < b), middle, a))
    return out


class _Top:
    """The upper nodes of all trees, numbered per tree; ``cuts`` has the thresholds tried in a node, if not the common ones."""

    def __init__(self, trees: int) -> None:
        self.feature, self.threshold, self.left = ([[v] for _ in range(trees)] for v in (-1, 0.0, -1))
        self.cuts: dict[tuple[int, int], list[np.ndarray]] = {}

    def split(self, tree: int, node: int, feature: int, threshold: float) -> tuple[int, int]:
        kid = len(self.feature[tree])
        self.feature[tree][node], self.threshold[tree][node], self.left[tree][node] = feature, threshold, kid
        self.feature[tree] += [-1, -1]
        self.threshold[tree] += [0.0, 0.0]
        self.left[tree] += [-1, -1]
        return kid, kid + 1

    def arrays(self) -> list[dict[str, np.ndarray]]:
        return [{"feature": np.array(f), "threshold": np.array(t), "left": np.array(n)}
                for f, t, n in zip(self.feature, self.threshold, self.left)]


def _place(x: np.ndarray, tree: dict[str, np.ndarray]) -> np.ndarray:
    """The top node in which each row ends (``x`` without NaN)."""
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(rows):
        f = tree["feature"][at[rows]]
        rows, f = rows[f >= 0], f[f >= 0]
        here = at[rows]
        at[rows] = tree["left"][here] + (x[rows, f] > tree["threshold"][here])
    return at


def _unpacked(batch: pa.RecordBatch, trees: int) -> tuple[np.ndarray, ...]:
    """at, mark, y, w, x (NaN: infinity) and counts per tree of a batch of training rows."""
    get = dict(zip(batch.schema.names, batch.columns))
    x = _matrix(get["x"])
    drawn = np.frombuffer(b"".join(get["drawn"].to_pylist()), np.uint8).reshape(-1, trees)
    return (*(get[c].to_numpy(zero_copy_only=False) for c in ("at", "mark", "y", "w")), np.where(np.isnan(x), np.inf, x), drawn)


def _binned(rows: DataFrame, trees: int, top: _Top, active: dict[int, list[int]], cuts: list[np.ndarray]) -> DataFrame:
    """tree, node, counts: per feature and bin the number of drawn rows, their weight and that of class 1, from each task."""
    sent = rows.sparkSession.sparkContext.broadcast((top.arrays(), active, cuts, {n: c for n, c in top.cuts.items() if n[1] in active.get(n[0], ())}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown, nodes, common, own = sent.value
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            _, _, y, w, x, drawn = _unpacked(batch, trees)
            if not len(x):
                continue
            code = np.stack([np.searchsorted(c, v) for c, v in zip(common, x.T)], axis=1)
            width = x.shape[1]
            for t, wanted in nodes.items():
                slot = np.full(len(grown[t]["feature"]), -1)
                slot[wanted] = np.arange(len(wanted))
                here = np.flatnonzero((drawn[:, t] > 0) & (w > 0))
                at = slot[_place(x[here], grown[t])]
                here, at = here[at >= 0], at[at >= 0]
                weight = np.round(w[here] * drawn[here, t] * _ONE) / _ONE
                bins = code[here]
                for i, node in enumerate(wanted):
                    if (t, node) in own:
                        r = np.flatnonzero(at == i)
                        bins[r] = np.stack([np.searchsorted(c, v) for c, v in zip(own[t, node], x[here[r]].T)], axis=1)
                cell = ((at[:, None] * width + np.arange(width)) * BINS + bins).ravel()
                size = len(wanted) * width * BINS
                found = np.stack([np.bincount(cell, v, size) for v in (None, np.repeat(weight, width), np.repeat(weight * y[here], width))])
                sums[t] = sums[t] + found if t in sums else found
        for t, found in sums.items():
            wanted = nodes[t]
            each = np.ascontiguousarray(found.reshape(3, len(wanted), -1).swapaxes(0, 1))
            yield pa.RecordBatch.from_arrays([pa.array([t] * len(wanted), pa.int32()), pa.array(wanted, pa.int32()),
                                              pa.array([e.tobytes() for e in each], pa.binary())], ["tree", "node", "counts"])

    return rows.mapInArrow(run, "tree int, node int, counts binary")


_SPLITS = ("tree int, node int, feature int, cut int, gain double, n_left long, n_right long, w_left double, w_right double, "
           "ones_left double, ones_right double")


def _splits(binned: DataFrame, width: int, seed: int, k: int, min_leaf: int, tasks: int) -> DataFrame:
    """The best split of each node; feature -1 if its bins give none (left: the whole node)."""
    def run(group: pa.Table) -> pa.Table:
        t, node = group.column("tree")[0].as_py(), group.column("node")[0].as_py()
        c = np.sum([np.frombuffer(b, float).reshape(3, width, BINS) for b in group.column("counts").to_pylist()], axis=0)
        n, total, ones = c[:, 0].sum(axis=1)
        varies = (c[0] > 0).sum(axis=1) > 1
        rank = np.where(varies, _ranks(np.array([hash_text(f"{seed} {t} top {node}")], np.uint64), width)[0], _U(1 << 63))
        best = (-1, -1, -np.inf)
        for f in sorted(np.argsort(rank, kind="stable")[:k]):
            if not varies[f]:
                continue
            nl, wl, l1 = np.cumsum(c[:, f], axis=1)[:, :-1]
            wr, r1 = total - wl, ones - l1
            ok = (nl >= min_leaf) & (n - nl >= min_leaf) & (nl > 0) & (nl < n) & (wl > 0) & (wr > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                s = np.where(ok, (l1 * l1 + (wl - l1) ** 2) / wl + (r1 * r1 + (wr - r1) ** 2) / wr, -np.inf)
            j = int(np.argmax(s))
            if s[j] > best[2]:
                best = (int(f), j, float(s[j]))
        f, j, s = best
        nl, wl, l1 = c[:, f, :j + 1].sum(axis=1) if f >= 0 else (n, total, ones)
        gain = s - (ones ** 2 + (total - ones) ** 2) / total if f >= 0 else 0.0
        return pa.Table.from_pylist([dict(tree=t, node=node, feature=f, cut=j, gain=float(gain), n_left=int(nl), n_right=int(n - nl),
                                          w_left=float(wl), w_right=float(total - wl), ones_left=float(l1), ones_right=float(ones - l1))],
                                    schema=pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("cut", pa.int32()),
                                                      ("gain", pa.float64()), ("n_left", pa.int64()), ("n_right", pa.int64()),
                                                      *[(c, pa.float64()) for c in ("w_left", "w_right", "ones_left", "ones_right")]]))

    return binned.repartition(tasks, "tree", "node").groupBy("tree", "node").applyInArrow(run, _SPLITS)


def _own_cuts(rows: DataFrame, trees: int, top: _Top, stuck: dict[tuple[int, int], int], width: int) -> dict[tuple[int, int], list[np.ndarray]]:
    """Thresholds from a node's own rows: quantiles of a hash-chosen share of them, with the ends of each feature."""
    sent = rows.sparkSession.sparkContext.broadcast((top.arrays(), stuck))

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown, wanted = sent.value
        for batch in batches:
            _, mark, _, w, x, drawn = _unpacked(batch, trees)
            for t in sorted({t for t, _ in wanted}):
                here = np.flatnonzero((drawn[:, t] > 0) & (w > 0))
                at = _place(x[here], grown[t])
                found = []
                for node in sorted(n for u, n in wanted if u == t):
                    r = here[at == node]
                    if len(r):
                        share = min(1.0, _SAMPLE_ROWS / wanted[t, node])
                        some = x[r[(mark[r].view(np.uint64) >> _U(11)) / float(1 << 53) < share]]
                        ends = np.stack([x[r].min(axis=0), x[r].max(axis=0)])
                        found.append((t, node, np.unique(some, axis=0).tobytes(), ends.tobytes()))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                                     ["tree", "node", "some", "ends"])

    def cut(group: pa.Table) -> pa.Table:
        some, ends = (np.frombuffer(b"".join(group.column(c).to_pylist()), float).reshape(-1, width) for c in ("some", "ends"))
        low, high = ends.min(axis=0), ends.max(axis=0)
        out = [np.unique(np.append(c[(c >= a) & (c < b)], a if a < b else [])) for c, a, b in zip(_cuts(some, BINS - 1), low, high)] \
            if len(some) else [np.array([a] if a < b else []) for a, b in zip(low, high)]
        return pa.table({"tree": group.column("tree")[:1], "node": group.column("node")[:1], "cuts": pa.array([[c.tolist() for c in out]], pa.list_(pa.list_(pa.float64())))})

    found = (rows.mapInArrow(picked, "tree int, node int, some binary, ends binary")
             .groupBy("tree", "node").applyInArrow(cut, "tree int, node int, cuts array<array<double>>"))
    return {(r.tree, r.node): [np.array(c, float) for c in r.cuts] for r in found.collect()}


# ------------------------------------------------------------------ the bottom levels
def _blocks(rows: DataFrame, trees: int, tops: list[dict[str, np.ndarray]] | None, closed: list[list[int]]) -> DataFrame:
    """tree, node, at, y, w, x: the drawn rows of a batch in each node that is not closed, as arrays in bytes."""
    sent = rows.sparkSession.sparkContext.broadcast((tops, closed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown, shut = sent.value
        for batch in batches:
            at, _, y, w, x, drawn = _unpacked(batch, trees)
            for t in range(trees):
                here = np.flatnonzero((drawn[:, t] > 0) & (w > 0))
                node = _place(x[here], grown[t]) if grown else np.zeros(len(here), np.int64)
                keep = ~np.isin(node, shut[t])
                order = np.argsort(node[keep], kind="stable")
                here, node = here[keep][order], node[keep][order]
                found, first = np.unique(node, return_index=True)
                parts = [here[a:b] for a, b in zip(first, [*first[1:], len(here)])]
                if parts:
                    cells = [[v.tobytes() for v in (at[p], y[p], w[p] * drawn[p, t], x[p])] for p in parts]
                    yield pa.RecordBatch.from_arrays([pa.array([t] * len(parts), pa.int32()), pa.array(found, pa.int32()),
                                                      *[pa.array(c, pa.binary()) for c in zip(*cells)]], ["tree", "node", "at", "y", "w", "x"])

    return rows.mapInArrow(run, "tree int, node int, at binary, y binary, w binary, x binary")


def _grown(blocks: DataFrame, seed: int, width: int, depths: dict[tuple[int, int], int], rooted: bool, tasks: int, limits: tuple) -> DataFrame:
    """The subtrees below the nodes, each grown in one task; ``depths``: the levels above a node."""
    k, min_split, min_leaf, max_depth = limits
    sent = blocks.sparkSession.sparkContext.broadcast(depths)

    def run(group: pa.Table) -> pa.Table:
        tree, node = group.column("tree")[0].as_py(), group.column("node")[0].as_py()
        path = "" if rooted else str(node)
        y, w, x = (np.frombuffer(b"".join(group.column(c).to_pylist()), float) for c in ("y", "w", "x"))
        at, x = np.frombuffer(b"".join(group.column("at").to_pylist()), np.int64), x.reshape(-1, width)
        order = np.argsort(at, kind="stable")
        if (np.diff(at[order]) == 0).any():
            order = np.lexsort((*x.T, y, at))  # the same sums for any order of arrival
        own = hash_text(f"{seed} {tree} {path}")
        below = None if max_depth is None else max_depth - sent.value.get((tree, node), 0)
        return _subtree(tree, path, grow(x[order], y[order], w[order], own, k, min_split, min_leaf, below))

    return blocks.repartition(tasks, "tree", "node").groupBy("tree", "node").applyInArrow(run, _SUBTREES)


def _subtree(tree: int, path: str, grown: dict[str, np.ndarray]) -> pa.Table:
    names = ["feature", "threshold", "left", "right", "share", "gain", "weight"]
    kinds = [pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]

    def one(c: str, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(grown[c])], pa.int32()), pa.array(grown[c], kind))

    return pa.table({"tree": pa.array([tree], pa.int32()), "path": [path], **{c: one(c, t) for c, t in zip(names, kinds)}})


# ------------------------------------------------------------------ the forest
class DeepForest:
    """Settings of an unfitted forest; ``fit`` gives a :class:`DeepForestModel`."""

    def __init__(self, trees: int = 100, seed: int = 0, features: int | None = None, min_split: int = 2, min_leaf: int = 1,
                 max_depth: int | None = None, weight_col: str | None = None, node_rows: int = NODE_ROWS) -> None:
        self.trees, self.seed, self.features, self.min_split = trees, seed, features, min_split
        self.min_leaf, self.max_depth, self.weight_col, self.node_rows = min_leaf, max_depth, weight_col, node_rows

    def fit(self, train: DataFrame, label: str, key: str, vector: str = "features") -> DeepForestModel:
        """Fit on a vector column; ``key`` identifies a row."""
        weight = F.col(self.weight_col).cast("double") if self.weight_col else F.lit(1.0)
        rows = train.select(F.col(key).alias("key"), F.col(label).cast("double").alias("y"), weight.alias("w"), vector_to_array(F.col(vector)).alias("x"))
        hashes = F.array(*[F.xxhash64(F.lit(self.seed), F.lit(t), F.col("key")) for t in range(self.trees)])
        rows = rows.select(F.xxhash64("key").alias("at"), F.xxhash64("key", "y", "x").alias("mark"), "y", "w", "x", hashes.alias("hashes"))
        n = train.count()
        rows = rows.repartition(_parts(rows.sparkSession, n))
        rows = shared_table(rows.mapInArrow(_with_counts, "at long, mark long, y double, w double, x array<double>, drawn binary"), "forest-rows")
        width = len(rows.first()["x"]) if n else 0
        k = min(self.features or max(1, math.isqrt(width)), max(1, width))
        model = DeepForestModel(rows.sparkSession, self.trees, width)
        if n > self.node_rows:
            self._rounds(model, rows, n, k)
        closed: list[list[int]] = [[] for _ in range(self.trees)]
        for t, node in model.closed:
            closed[t].append(node)
        blocks = _blocks(rows, self.trees, model.top, closed)
        open_nodes = self.trees if model.top is None else sum(int((t["feature"] < 0).sum()) for t in model.top)
        subtrees = _grown(blocks, self.seed, width, model.depths, model.top is None, min(4000, 2 * open_nodes),
                          (k, self.min_split, self.min_leaf, self.max_depth))
        if model.closed:
            subtrees = subtrees.unionByName(rows.sparkSession.createDataFrame(
                [(t, str(node), [-1], [0.0], [-1], [-1], [ones / total if total else 0.0], [0.0], [total])
                 for (t, node), (total, ones) in model.closed.items()], _SUBTREES).repartition(8))
        model.subtrees = shared_table(subtrees, "forest")
        return model

    def _rounds(self, model: DeepForestModel, rows: DataFrame, n: int, k: int) -> None:
        """Split the nodes of more than ``node_rows`` rows, a round for all of them, until none is left."""
        top = _Top(self.trees)
        shallow = self.max_depth is not None and self.trees << min(self.max_depth, 40) <= _ROUND_NODES
        share = min(1.0, 4 * _SAMPLE_ROWS / n)
        some = rows.where(F.shiftrightunsigned("mark", 11) / float(1 << 53) < share) if share < 1 else rows
        some = some.select("mark", "x").orderBy("mark").limit(_SAMPLE_ROWS).toArrow().column("x")
        cuts = _cuts(_matrix(some), BINS) if len(some) else [np.array([])] * model.width
        active = {(t, 0): 0 for t in range(self.trees)}  # node -> levels above it
        while active:
            # at most trees * rows / node_rows nodes: far fewer than rows
            nodes: dict[int, list[int]] = {}
            for t, node in sorted(active):
                nodes.setdefault(t, []).append(node)
            best = _splits(_binned(rows, self.trees, top, nodes, cuts), model.width, self.seed, k, self.min_leaf,
                           min(len(active), 2 * rows.sparkSession.sparkContext.defaultParallelism)).collect()
            following, stuck, made = {}, {}, {}
            for r in sorted(best, key=lambda r: (r.tree, r.node)):
                at, depth = (r.tree, r.node), active[r.tree, r.node]
                total, ones = r.w_left + r.w_right, r.ones_left + r.ones_right
                done = ones <= 0 or ones >= total or depth == self.max_depth or r.n_left + r.n_right < max(2, self.min_split)
                if not done and r.feature < 0 and at not in top.cuts:
                    stuck[at] = r.n_left
                elif done or r.feature < 0:
                    model.closed[at] = (total, ones)
                else:
                    threshold = float((top.cuts.get(at) or cuts)[r.feature][r.cut])
                    made[at] = (r.feature, threshold)
                    kids = top.split(*at, r.feature, threshold)
                    model.gains.append((r.tree, r.feature, float(r.gain)))
                    for kid, size, w, one in zip(kids, (r.n_left, r.n_right), (r.w_left, r.w_right), (r.ones_left, r.ones_right)):
                        below = (r.tree, kid)
                        model.depths[below] = depth + 1
                        if one <= 0 or one >= w or depth + 1 == self.max_depth:
                            model.closed[below] = (w, one)
                        elif size > self.node_rows or shallow:
                            following[below] = depth + 1
            if stuck:
                top.cuts.update(_own_cuts(rows, self.trees, top, stuck, model.width))
                following.update({at: active[at] for at in stuck if at in top.cuts})
            model.rounds.append(made)
            active = following
        model.top = top.arrays()


def hash_text(text: str) -> int:
    """A fixed 63-bit number of a text."""
    out = 0
    for ch in text.encode():
        out = (out * 1_099_511_628_211 + ch + 1) % (1 << 63)
    return out


def _parts(spark: SparkSession, rows: int) -> int:
    """Partitions for so many rows: some for every core, at most 50,000 rows in one."""
    return max(1, min(math.ceil(rows / 5000), max(2 * spark.sparkContext.defaultParallelism, math.ceil(rows / 50_000))))


def _joined_trees(packed: pa.Table, top: list[dict[str, np.ndarray]] | None) -> list[tuple[int, dict[str, np.ndarray]]]:
    """(tree, nodes) in order: subtrees (as :meth:`DeepForestModel._packed` gives them) below the top's nodes."""
    parts: dict[int, list] = {}
    for t, path, *cells in zip(*(packed.column(c).to_pylist() for c in ("tree", "path", "feature", "value", "left"))):
        parts.setdefault(t, []).append((path, *(np.frombuffer(c, k) for c, k in zip(cells, (np.int16, float, np.int32)))))
    out = []
    for t in sorted(parts):
        if top is None:
            _, feature, value, left = parts[t][0]
        else:
            feature, value, left = [top[t]["feature"]], [top[t]["threshold"]], [top[t]["left"].copy()]
            place = len(feature[0])
            for path, f, v, kids in sorted(parts[t], key=lambda p: int(p[0])):
                # the first node of a subtree takes the place of the top's node, the others follow
                at = int(path)
                moved = np.where(kids >= 0, kids + place - 1, -1)
                feature[0], value[0] = feature[0].copy(), value[0].copy()
                feature[0][at], value[0][at], left[0][at] = f[0], v[0], moved[0]
                feature.append(f[1:])
                value.append(v[1:])
                left.append(moved[1:])
                place += len(f) - 1
            feature, value, left = np.concatenate(feature), np.concatenate(value), np.concatenate(left)
        out.append((t, {"feature": np.asarray(feature, np.int64), "threshold": value, "left": left, "right": left + 1, "share": value}))
    return out


class DeepForestModel:
    """A fitted forest: the top levels of its trees, if any, and a table of subtrees."""

    def __init__(self, spark: SparkSession, trees: int, width: int) -> None:
        self.spark, self.trees, self.width = spark, trees, width
        self.top: list[dict[str, np.ndarray]] | None = None  # per tree: feature (-1: a subtree begins), threshold, left
        self.rounds: list[dict[tuple[int, int], tuple[int, float]]] = []  # what each round of the top has split
        self.gains: list[tuple[int, int, float]] = []  # tree, feature, gain of the top's splits
        self.depths: dict[tuple[int, int], int] = {}
        self.closed: dict[tuple[int, int], tuple[float, float]] = {}  # leaves of the top: weight, that of class 1
        self.subtrees: DataFrame | None = None

    @property
    def refined(self) -> list[dict]:
        """The rounds after the first: nodes that were still too large."""
        return self.rounds[1:]

    # -------------------------------------------------------------- scoring
    def size_bytes(self) -> int:
        """Bytes of the subtrees as arrays."""
        nodes = self.subtrees.agg(F.coalesce(F.sum(F.size("feature")), F.lit(0))).first()[0]
        return int(nodes) * _NODE_BYTES

    def score(self, df: DataFrame, vector: str = "features", out: str = "churn_probability",
              broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """``df`` with the mean share of class 1 over the trees in ``out``."""
        size = self.size_bytes()
        if size <= broadcast_bytes:
            return self._score_sent(df, vector, out)
        return self._score_joined(df, vector, out, size)

    def _packed(self) -> DataFrame:
        """tree, path, feature, value, left: a subtree as bytes; value is the threshold or, of a leaf, the share; right is left + 1."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells = []
                for i in range(batch.num_rows):
                    feature, threshold, left, share = (batch.column(c)[i].values.to_numpy() for c in range(2, 6))
                    cells.append((feature.astype(np.int16).tobytes(), np.where(feature >= 0, threshold, share).tobytes(), left.astype(np.int32).tobytes()))
                columns = list(zip(*cells)) if cells else [(), (), ()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *[pa.array(c, pa.binary()) for c in columns]], ["tree", "path", "feature", "value", "left"])

        return (self.subtrees.select("tree", "path", "feature", "threshold", "left", "share")
                .mapInArrow(run, "tree int, path string, feature binary, value binary, left binary"))

    def _score_sent(self, df: DataFrame, vector: str, out: str) -> DataFrame:
        sent = self.spark.sparkContext.broadcast(_joined_trees(self._packed().toArrow(), self.top))
        trees, kept = self.trees, df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, total = _matrix(batch.column(batch.num_columns - 1)), np.zeros(batch.num_rows)
                for _, tree in sent.value:
                    total += walk(x, tree)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(total / trees)], [*kept[:-1], out])

        kept = [c for c in df.columns if c != vector] + ["__x"]
        fields = df.select(*kept[:-1]).schema.add(out, "double")
        return df.withColumn("__x", vector_to_array(F.col(vector))).select(*kept).mapInArrow(run, fields)

    def _score_joined(self, df: DataFrame, vector: str, out: str, size: int) -> DataFrame:
        """Blocks of rows meet shares of the trees: ``deals`` of blocks times ``chunks`` of trees are the tasks."""
        n = df.count()
        parts = _parts(self.spark, n)
        rows = shared_table(df.withColumn("x", vector_to_array(F.col(vector))).drop(vector).repartition(parts)
                            .withColumn("__row", F.monotonically_increasing_id()), "forest-input")
        chunks = min(self.trees, max(1, math.ceil(size * 14 / _NODE_BYTES / _TREES_BYTES)))
        deals = max(1, math.ceil(n / _BLOCKS_ROWS), math.ceil(2 * self.spark.sparkContext.defaultParallelism / chunks))
        width, top = self.width, self.spark.sparkContext.broadcast(self.top)

        def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, _BATCH_ROWS):
                    part = batch.slice(a, _BATCH_ROWS)
                    ids = part.column(0).to_numpy()
                    yield pa.RecordBatch.from_arrays([pa.array(ids[:1], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
                                                      pa.array([_matrix(part.column(1)).tobytes()], pa.binary())], ["block", "ids", "x"])

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            trees = _joined_trees(right, top.value) if left.num_rows and right.num_rows else []
            cells = []
            for x in left.column("x").to_pylist() if trees else []:
                x = np.frombuffer(x, float).reshape(-1, width)
                cells.append(np.stack([walk(x, tree) for _, tree in trees]).tobytes())
            found = left.slice(0, len(cells))
            return pa.table({"block": found.column("block"), "ids": found.column("ids"),
                             "first": pa.array([t for t, _ in trees[:1]] * len(cells), pa.int32()), "shares": pa.array(cells, pa.binary())})

        def mean(group: pa.Table) -> pa.Table:
            ids = np.frombuffer(group.column("ids")[0].as_py(), np.int64)
            total = np.zeros(len(ids))
            # one share per tree, added in the order of the trees
            for _, cells in sorted(zip(group.column("first").to_pylist(), group.column("shares").to_pylist())):
                for share in np.frombuffer(cells, float).reshape(-1, len(ids)):
                    total += share
            return pa.table({"__row": pa.array(ids), out: pa.array(total / self_trees)})

        self_trees = self.trees
        blocks = rows.select("__row", "x").mapInArrow(block, "block long, ids binary, x binary")
        blocks = (blocks.withColumn("deal", F.pmod(F.xxhash64("block"), F.lit(deals)).cast("int"))
                  .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
        # neighbouring trees share a chunk, so that shares are added in the order of the trees
        copies = (self._packed().withColumn("chunk", F.floor(F.col("tree") * F.lit(chunks) / F.lit(self.trees)).cast("int"))
                  .withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1)))))
        tasks = min(4000, 2 * deals * chunks)
        each = (blocks.repartition(tasks, "chunk", "deal").groupBy("chunk", "deal")
                .cogroup(copies.repartition(tasks, "chunk", "deal").groupBy("chunk", "deal"))
                .applyInArrow(run, "block long, ids binary, first int, shares binary"))
        scored = each.repartition(parts, "block").groupBy("block").applyInArrow(mean, f"__row long, `{out}` double")
        return rows.join(scored, "__row").drop("__row", "x")

    # -------------------------------------------------------------- contents
    def nodes(self) -> DataFrame:
        """tree, path, node, feature (-1: leaf), threshold, left, right, share, gain, weight: one row per node."""
        names = ["feature", "threshold", "left", "right", "share", "gain", "weight"]
        return (self.subtrees.select("tree", "path", F.posexplode(F.arrays_zip(*names)).alias("node", "n"))
                .select("tree", "path", "node", *[F.col(f"n.{c}") for c in names]))

    def importance(self) -> list[float]:
        """Share of the Gini decrease per feature: per tree, then the mean of the trees that have splits."""
        found = self.nodes().where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
        rows = found.collect()  # at most one per tree and feature
        each = np.zeros((self.trees, self.width))
        for tree, feature, gain in [*rows, *self.gains]:
            each[tree, feature] += gain
        total = each.sum(axis=1)
        each = each[total > 0] / total[total > 0, None]
        return (each.mean(axis=0) if len(each) else np.zeros(self.width)).tolist()

    # -------------------------------------------------------------- S6
    def save(self, path: str) -> None:
        """Subtrees as Parquet, the top and the settings as text."""
        self.subtrees.write.mode("overwrite").parquet(os.path.join(path, "subtrees"))
        top = None if self.top is None else [{c: v.tolist() for c, v in tree.items()} for tree in self.top]
        meta = json.dumps({"trees": self.trees, "width": self.width, "top": top, "gains": self.gains})
        self.spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(path, "settings"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DeepForestModel:
        meta = json.loads(spark.read.text(os.path.join(path, "settings")).first().value)
        model = cls(spark, meta["trees"], meta["width"])
        model.subtrees = spark.read.schema(_SUBTREES).parquet(os.path.join(path, "subtrees"))
        if meta["top"] is not None:
            model.top = [{c: np.array(v) for c, v in tree.items()} for tree in meta["top"]]
        model.gains = [tuple(g) for g in meta["gains"]]
        return model
