"""Drift sketches, category dictionary, row digests and blocked correlations."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kohort.operators import aggregates as A
from kohort.operators import categories, drift, features, gram, quality
from kohort.operators import drift_sketch as DS


# ------------------------------------------------------------------ D2 sketches
def _snapshot(spark, n, shift, seed=0):
    noise = F.randn(seed)
    return spark.range(n).select((noise * 3 + 50 + shift).alias("a"), F.exp(F.randn(seed + 1) + shift / 10).alias("b"),
                                 F.when(F.col("id") % 3 == 0, None).otherwise(F.floor(F.rand(seed + 2) * 7)).cast("double").alias("c"))


def test_sketch_scores_lie_within_the_bound(spark):
    ref, cur = _snapshot(spark, 60_000, 0.0), _snapshot(spark, 50_000, 0.7, 5)
    exact = {r.column_name: r.drift_score for r in drift.numeric_drift(ref, cur, ["a", "b", "c"]).collect()}
    for size in (200, 4096):
        got = DS.sketch_drift(DS.sketch(ref, ["a", "b", "c"], size), DS.sketch(cur, ["a", "b", "c"], size), ["a", "b", "c"], size=size).collect()
        assert {r.column_name for r in got} == set(exact)
        for r in got:
            assert abs(r.drift_score - exact[r.column_name]) <= r.error_bound, r
            if r.certain:
                assert r.drift_detected == (exact[r.column_name] >= 0.1)
    assert DS.rank_error(4096) < 0.0014


def test_merged_sketches(spark, tmp_path):
    """Parts merged in any order stay within the bound of the whole, from storage too."""
    ref, cur = _snapshot(spark, 30_000, 0.0), _snapshot(spark, 30_000, 0.5, 9)
    parts = [cur.where(F.pmod(F.xxhash64("a"), F.lit(3)) == k) for k in range(3)]
    exact = {r.column_name: r.drift_score for r in drift.numeric_drift(ref, cur, ["a", "b", "c"]).collect()}
    whole = DS.sketch(ref, ["a", "b", "c"])
    path = str(tmp_path / "sketches")
    for k in (2, 0, 1, 0):  # one is stored twice
        DS.store(DS.sketch(parts[k], ["a", "b", "c"]), path, f"day{k}")
    merged = DS.stored(spark, path, ["day1", "day0", "day2"])
    assert {r.column_name: r.n for r in merged.collect()} == {r.column_name: r.n for r in DS.sketch(cur, ["a", "b", "c"]).collect()}
    for r in DS.sketch_drift(whole, merged, ["a", "b", "c"]).collect():
        assert abs(r.drift_score - exact[r.column_name]) <= r.error_bound


def test_sketch_of_odd_columns(spark):
    ref = spark.createDataFrame([(1.0, None, 5.0, float("nan")), (2.0, None, 5.0, None)], "a double, b double, c double, d double")
    cur = spark.createDataFrame([(1.0, 3.0, 6.0, None), (2.0, None, 6.0, None)], "a double, b double, c double, d double")
    got = {r.column_name: r.drift_score for r in DS.sketch_drift(DS.sketch(ref, list("abcd")), DS.sketch(cur, list("abcd")), list("abcd")).collect()}
    assert got == {"a": 0.0, "b": float("inf"), "c": float("inf"), "d": 0.0}


# ------------------------------------------------------------------ M2 dictionary
def test_codes_equal_sorted_order(spark):
    rnd = random.Random(3)
    values = [rnd.choice(["", "a", "B", "é", "zz", "日本", "10", "9"]) for _ in range(300)] + [None]
    df = spark.createDataFrame([(i, v, v and v[:1]) for i, v in enumerate(values)], "id int, p string, q string").repartition(5)
    codes = features.fit_ordinal(df, ["p", "q"])
    for c in ("p", "q"):
        want = {v: i for i, v in enumerate(sorted({r[c] for r in df.collect()} - {None}, key=lambda s: s.encode()))}
        assert {r.value: r.code for r in codes.where(F.col("column_name") == c).collect()} == want
        got = {r[c]: r[f"{c}_code"] for r in features.apply_ordinal(df, codes, ["p", "q"]).collect()}
        assert got == {**want, None: -1}
    unseen = spark.createDataFrame([(1, "nowhere", "a")], "id int, p string, q string")
    assert features.apply_ordinal(unseen, codes, ["p", "q"]).first()["p_code"] == -1


def test_a_million_categories(spark):
    n = 1_000_000
    df = spark.range(n).select(F.format_string("%07d", (F.col("id") * 7919) % n).alias("p"))
    codes = categories.category_codes(df.repartition(3), ["p"])
    wrong = codes.where(F.col("code") != F.col("value").cast("long")).count()
    assert wrong == 0 and codes.count() == n


def test_codes_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, p string")
    assert features.fit_ordinal(df, ["p"]).count() == 0


# ------------------------------------------------------------------ Q5 digests
def test_distinct_rows_by_digest(spark):
    rows = [(1, "a", None), (1, None, "a"), (1, "a", None), (None, "a", None), (None, None, None), (None, None, None), (2, "", "a"), (2, "a", "")]
    df = spark.createDataFrame(rows, "x int, y string, z string")
    assert quality.count_distinct_rows(df).first().distinct_rows == df.distinct().count() == 6
    assert quality.count_distinct_rows(df.limit(0)).first().distinct_rows == 0


def test_equal_digests_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(quality, "row_digests", lambda df: [F.lit(1).alias("__h1"), (F.col("x") % 2).alias("__h2")])
    df = spark.createDataFrame([(i % 7, str(i % 3)) for i in range(60)], "x int, y string")
    assert quality.count_distinct_rows(df).first().distinct_rows == 21


# ------------------------------------------------------------------ A23 correlations
def _plain(rows, i, j):
    both = np.array([(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None], float)
    if len(both) < 2 or (both == both[0]).all(axis=0).any():
        return None
    return float(np.corrcoef(both.T)[0, 1])


@pytest.mark.parametrize("block", [3, 64])
def test_pairwise_complete_correlations(spark, monkeypatch, block):
    monkeypatch.setattr(gram, "BLOCK", block)
    rng = np.random.default_rng(2)
    base = rng.normal(0, 1, (400, 8)) @ rng.normal(0, 1, (8, 8)) + 1e6
    rows = [[None if rng.random() < 0.2 else float(v) for v in r] for r in base]
    for k, r in enumerate(rows):
        r[6] = 42.5  # constant
        r[7] = float(k) if k in (3, 5) else None  # two rows only
    names = [f"n{i}" for i in range(8)]
    df = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} double" for c in names)).repartition(5)
    got = {(r.col_a, r.col_b): r.corr for r in A.correlation_matrix(df, names, digits=9).collect()}
    assert len(got) == 64
    for i, j in itertools.product(range(8), repeat=2):
        want = _plain(rows, i, j)
        value = got[names[i], names[j]]
        assert (value is None) == (want is None), (i, j, value, want)
        assert want is None or abs(value - want) < 1e-7


def test_a_thousand_columns(spark):
    n = 1000
    df = spark.range(60).select(*[F.sin(F.col("id") * (k + 1)).alias(f"n{k}") for k in range(n)])
    out = A.correlation_matrix(df, [f"n{k}" for k in range(n)])
    assert out.count() == n * n
    x = np.sin(np.arange(60)[:, None] * (np.arange(n) + 1.0))
    got = out.where("col_a = 'n7' AND col_b IN ('n900', 'n64', 'n7')").collect()
    for r in got:
        assert abs(r.corr - np.corrcoef(x[:, 7], x[:, int(r.col_b[1:])])[0, 1]) < 1e-6


# ------------------------------------------------------------------ Q4 top values
def _plain_top(df, columns, k):
    out = []
    for c in columns:
        counts = {}
        for r in df.select(c).collect():
            if r[0] is not None:
                counts[str(r[0])] = counts.get(str(r[0]), 0) + 1
        top = sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:k]
        out += [(c, v, n, i + 1) for i, (v, n) in enumerate(top)]
    return sorted(out)


@pytest.mark.parametrize("tracked", [16, 10_000])
def test_top_values_are_exact(spark, monkeypatch, tracked):
    monkeypatch.setattr(quality, "TRACKED", tracked)
    monkeypatch.setattr(quality, "NAMED_SHARE", 2 * 3.5 * 0.75 / tracked)
    rnd = random.Random(6)
    rows = [(rnd.choice("abc"), f"v{min(int(rnd.expovariate(0.3)), 400)}" if i % 3 else f"u{i}", f"id{i}", i % 11 if i % 5 else None, None)
            for i in range(4000)]
    df = spark.createDataFrame(rows, "few string, heavy string, flat string, number int, none string").repartition(6)
    cols = ["few", "heavy", "flat", "number", "none"]
    for k in (1, 5, 30):
        assert sorted(tuple(r) for r in quality.top_values(df, cols, k).collect()) == _plain_top(df, cols, k)


def test_wide_domain_is_not_shuffled_whole(spark, monkeypatch):
    """Heavy values among many rare ones: only candidates are counted."""
    tables = {}
    write = quality.shared_table
    monkeypatch.setattr(quality, "shared_table", lambda df, name: tables.setdefault(name, write(df, name)))
    df = spark.range(300_000).select(F.when(F.col("id") % 4 == 0, F.concat(F.lit("hot"), F.col("id") % 5)).otherwise(F.col("id").cast("string")).alias("v"))
    top = quality.top_values(df, ["v"], 5).collect()
    assert [(r.value, r["count"]) for r in top] == [(f"hot{i}", 15_000) for i in range(5)]
    assert tables["counted"].count() <= quality.TRACKED
