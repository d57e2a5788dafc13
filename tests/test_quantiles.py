"""The exact quantiles equal Spark's percentile, by the same steps at every size."""

from __future__ import annotations

import random

import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kohort.operators import quantiles as Q
from kohort.operators import revenue as R
from kohort.operators.quantiles import median_table, quantile_array, quantile_table
from kohort.sources import mart
from kohort.sources.tables import Tables


def reference(df, probs, by):
    arr = F.percentile("x", F.array(*[F.lit(p) for p in probs]))
    return {(*[r[k] for k in by], i): q for r in df.groupBy(*by).agg(arr.alias("q")).collect() for i, q in enumerate(r.q or [])}


def found(df, probs, by):
    return {(*[r[k] for k in by], r.q_index): r.quantile for r in quantile_table(df, "x", probs, by).collect()}


PROBS = [0.9, 0.5, 0.0, 1.0, 0.25, 0.333, 0.001, 0.999] + [(i + 0.5) / 20 for i in range(20)]


@pytest.mark.parametrize("accuracy", [4, 50, 400, 10_000])
def test_skew_ties_null_keys_and_small_groups(spark, monkeypatch, accuracy):
    monkeypatch.setattr(Q, "ACCURACY", accuracy)  # small: wide brackets, or narrow ones in groups that are no single bracket
    rnd = random.Random(7)
    rows = []
    for g in range(2):
        for _ in range(1500):
            r = rnd.random()
            # a third of the rows hold one hot value
            rows.append((g, 7.0 if r < 0.34 else (round(rnd.gauss(100, 30), 2) if r < 0.9 else float(rnd.randint(0, 5)))))
    rows += [(9, 1.0), (9, 2.0), (9, 3.0), (9, 4.0), (8, 5.0), (8, None), (7, None), (None, 3.0), (None, 8.0)]
    df = spark.createDataFrame(rows, "g int, x double")
    assert found(df, PROBS, ["g"]) == {k: v for k, v in reference(df, PROBS, ["g"]).items() if k[0] != 7}


def test_extreme_values(spark):
    values = [0.0, -0.0, 1e300, -1e300, 5e-324, float("inf"), float("-inf"), 1.0, 1.0, 2.5, -7.0] + [float(i) for i in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    n = len(values)
    probs = [i / (n - 1) for i in range(n)]
    got = [found(df, [p], [])[(0,)] for p in probs[::6]]
    assert got == sorted(values)[::6]


def test_global_empty_and_nan(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 5)] + [(float("nan"),), (None,)], "x double")
    assert {r.p: r.quantile for r in quantile_table(df, "x", [0.5, 0.9]).collect()} == {0.5: 2.5, 0.9: 3.7}
    assert quantile_table(df.where("x > 10 AND NOT isnan(x)"), "x", [0.5]).count() == 0
    assert R.invoice_totals(spark.createDataFrame([], "amount decimal(18,2)")).first().median_amount is None
    with pytest.raises(ValueError):
        quantile_table(df, "x", [])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6) | st.sampled_from([0.0, 1.5]), min_size=1, max_size=60), st.floats(0, 1))
def test_any_values(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert quantile_table(df, "x", [p]).first().quantile == df.agg(F.percentile("x", p)).first()[0]


def test_more_than_a_bracket_of_values(spark):
    """Many different values: several rounds, and still the exact ranks."""
    df = spark.range(60_000).select((F.col("id") * 7919 % 60_013).cast("double").alias("x"))
    assert found(df, [0.1, 0.5, 0.77], []) == reference(df, [0.1, 0.5, 0.77], [])


def test_listed_values_are_few(spark, monkeypatch):
    """Beyond a group's first ACCURACY values, only those near a wanted rank are listed one by one."""
    tables = {}
    write = Q.shared_table

    def watched(df, name):
        tables[name] = write(df, name)
        return tables[name]

    monkeypatch.setattr(Q, "shared_table", watched)
    n = 200_000
    df = spark.range(n).select((F.col("id") * 7919 % 200_003).cast("double").alias("x"))
    assert found(df, [0.25, 0.5], []) == reference(df, [0.25, 0.5], [])
    assert tables["counted"].count() <= 2 * 10 * n / Q.ACCURACY + 20


def test_number_of_jobs_is_fixed(spark, monkeypatch):
    """Three tables are written, whatever the values, the number of ranks or groups."""
    written = []
    write = Q.shared_table
    monkeypatch.setattr(Q, "shared_table", lambda df, name: written.append(name) or write(df, name))
    few = spark.createDataFrame([("a", 1.0)], "g string, x double")
    wide = spark.range(30_000).select((F.col("id") % 3).cast("string").alias("g"), F.pow(F.lit(1.01), F.col("id") % 9973).alias("x"))
    for df, probs in ((few, [0.5]), (wide, [0.5]), (wide, PROBS)):
        written.clear()
        assert quantile_table(df, "x", probs, ["g"]).count() > 0
        assert written == ["values", "groups", "counted"]


def test_arrays_follow_the_order_of_probs(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(11)], "g string, x double")
    assert quantile_array(df, "x", [1.0, 0.0, 0.5], ["g"]).first().quantiles == [10.0, 0.0, 5.0]
