"""Hard negatives against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kohort.llm import hard_negatives as hn


def brute(rows, positives=5, negatives=3, low=50, high=95, shift=True):
    use = []
    for vec_id, v, label in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if shift and vec_id % 7 == 0 else label
        use.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for a, la, va in {(a, la, tuple(va)) for a, la, va in use if a % 50 == 0}:
        scored = sorted(((sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in use if i != a), key=lambda s: (-s[0], s[1]))
        for p, pid, _ in [s for s in scored if s[2] == la][:positives]:
            hard = [s for s in scored if s[2] != la and low * p <= 100 * s[0] <= high * p][:negatives]
            out += [(a, pid, k + 1, n, p, s) for k, (s, n, _) in enumerate(hard)]
    return sorted(out)


@pytest.fixture
def run(spark, tmp_path):
    def f(rows):
        schema = "vec_id long, embedding array<float>, label int, id string, v string, lane string, windows string, qid string"
        table = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], schema)
        table.write.parquet(f"{tmp_path}/embeddings.parquet")
        return sorted(tuple(r) for r in hn.op13_hard_negatives(spark, str(tmp_path)).collect())

    return f


def vectors(n, d, seed, spread=0.35, skew=None):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, spread, (10, d))
    label = rng.integers(0, 10, n) if skew is None else np.where(rng.random(n) < skew, 0, rng.integers(0, 10, n))
    v = (centre[label] + rng.normal(0, 0.2, (n, d))).astype(np.float32)
    return [(i, v[i].tolist(), int(label[i])) for i in range(n)]


def test_random_vectors(run):
    rows = vectors(700, 24, 1)
    assert run(rows) == brute(rows)


def test_small_lanes_and_blocks(run, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 37)
    monkeypatch.setattr(hn, "QUERIES", 3)
    monkeypatch.setattr(hn, "mine", lambda rows, anchors, f=hn.mine: f(rows, anchors, lane_values=24 * 100))
    rows = vectors(900, 24, 2, skew=0.4)
    assert run(rows) == brute(rows)


def test_ties_and_odd_rows(run):
    same = [0.25, -0.5, 0.125, 0.0]
    rows = [(i, same, i % 3) for i in range(0, 120)]
    rows += [(200, None, 1), (250, [0.1, None, 0.2, 0.3], 1), (300, [float("nan")] * 4, 1), (350, [float("inf")] * 4, 1), (400, same, None),
             (450, [], 2), (500, [0.3], 2), (550, [0.1, 0.2, 0.3, 0.4, 0.9], 2), (None, same, 1), (600, [-x for x in same], 4), (650, [0.0] * 4, 5),
             (50, same, 2), (-50, [0.2, -0.4, 0.1, 0.01], 2), (601, [0.2, -0.3, 0.0, 0.5], 4), (701, [0.2, -0.31, 0.02, 0.5], 4)]
    assert run(rows) == brute(rows)


def test_large_components_stay_exact(run):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 1, 8) * 1e6).astype(np.float32).tolist(), int(i % 4)) for i in range(300)]
    assert run(rows) == brute(rows)


def test_components_beyond_long_do_not_crash(run):
    rows = [(i, [1e30 * (1 + i % 3), 1.0], i % 2) for i in range(60)]
    assert len(run(rows)) >= 0


def test_empty_table(run):
    assert run([]) == []


def test_pruning_needs_no_row_it_drops():
    """The index of one lane, with rows whose energy falls quickly: most pairs are never finished."""
    rng = np.random.default_rng(9)
    d = 64
    x = np.floor(256 * rng.normal(0, 1, (3000, d)) * np.exp(-np.arange(d) / 8)).astype(np.int64)
    labels = rng.integers(0, 3, 3000)
    lane = hn._Lane(np.arange(3000), labels, x)
    q = x[:40]
    found = lane.search(q, lambda rows: np.arange(3000)[rows] != np.arange(40)[:, None], np.float64, [[(hn._LOW, hn._HIGH)]] * 40, 5)
    score = q @ x.T
    for i in range(40):
        order = sorted((j for j in range(3000) if j != i), key=lambda j: (-score[i, j], j))[:5]
        assert found[i][0] == [(score[i, j], j) for j in order]


def test_general_interface(spark):
    rows = [(i, [float(i % 7), float(i % 5)], i % 2) for i in range(40)]
    table = hn.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long"), scale=1)
    got = hn.mine(table, table.where(F.col("id") < 3), positives=2, negatives=1, low=0, high=100).collect()
    assert {r.anchor_id for r in got} <= {0, 1, 2} and all(0 <= r.negative_score <= r.positive_score for r in got)
