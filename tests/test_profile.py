"""Aggregation, quality, cleaning and feature rules on micro tables."""

from __future__ import annotations

import pytest
from conftest import d
from pyspark.sql import functions as F

from kohort.functions.names import normalise_name, snake_case
from kohort.operators import aggregates as A
from kohort.operators import cleaning as CL
from kohort.operators import features as FE
from kohort.operators import quality as Q


@pytest.fixture
def values(spark):
    return spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")


def test_even_median_and_linear_quantile(values):
    row = values.agg(F.median("x").alias("m"), F.percentile("x", 0.9).alias("q")).first()
    assert row.m == 2.5
    assert abs(row.q - 3.7) < 1e-12


def test_describe_quartiles(values):
    r = A.describe(values, ["x"]).first()
    assert (r["count"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (4, 1.0, 1.75, 2.5, 3.25, 4.0)


def test_histogram_top_edge_and_constant(spark):
    df = spark.createDataFrame([(0.0, 5.0), (5.0, 5.0), (10.0, 5.0)], "a double, k double")
    bins = {(r.column_name, r.bin): r["count"] for r in A.histogram(df, ["a", "k"], 10).collect()}
    assert bins[("a", 10)] == 1 and bins[("a", 1)] == 1 and bins[("a", 6)] == 1
    assert {k: n for k, n in bins.items() if n} == {("a", 1): 1, ("a", 6): 1, ("a", 10): 1, ("k", 1): 3}
    assert len(bins) == 20  # empty bins are there, with count 0


def test_constant_column_correlation_and_scale(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (3.0, 3.0)], "a double, k double")
    corr = {(r.col_a, r.col_b): r.corr for r in A.correlation_matrix(df, ["a", "k"]).collect()}
    assert corr[("a", "a")] == 1.0 and corr[("a", "k")] is None
    scaled = FE.standard_scale(df, ["a", "k"]).collect()
    assert [r.k for r in scaled] == [0.0, 0.0, 0.0]


def test_names():
    assert normalise_name(" Last Interaction ") == "last_interaction"
    assert normalise_name("Support-Calls") == "support_calls"
    assert snake_case("SubscriptionID") == "subscription_id"
    assert snake_case("CustomerID") == "customer_id"


def test_normalise_columns(spark):
    df = spark.createDataFrame([(1, 2)], "` Last Interaction ` int, `Support-Calls` int")
    assert CL.normalise_columns(df).columns == ["last_interaction", "support_calls"]


def test_bad_dates(spark):
    df = spark.createDataFrame([("oops",), ("",), ("2020-02-03",)], "s string")
    got = [r.s for r in CL.parse_dates(df, ["s"]).collect()]
    assert got == [None, None, d("2020-02-03")]


def test_nullable_long(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "c string")
    assert [r.c for r in CL.to_nullable_long(df, "c").collect()] == [12, None, None]


def test_duplicate_rows_and_quality(spark):
    rows = [(1, None, "a")] * 3 + [(2, 5.0, None)]
    df = spark.createDataFrame(rows, "id int, v double, c string")
    rep = {(r.section, r.item): r.value for r in Q.quality_report(df).collect()}
    assert rep[("overview", "duplicate_rows")] == 2
    assert rep[("overview", "rows")] == 4
    assert rep[("missing_by_column", "v")] == 3
    assert ("missing_by_column", "id") not in rep
    assert rep[("unique_values", "c")] == 1
    assert rep[("data_types", "int")] == 1


def test_clean_imputes_median_and_unknown(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a"), (2, 2.0, None), (3, None, "b"), (4, 4.0, "b"), (4, 4.0, "b")],
        "id bigint, v double, c string")
    out = {r.id: (r.v, r.c) for r in CL.clean(df, ["v"], ["c"]).collect()}
    assert out == {1: (1.0, "a"), 2: (2.0, "Unknown"), 3: (2.0, "b"), 4: (4.0, "b")}


def test_unseen_category_gets_minus_one(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "p string")
    score = spark.createDataFrame([("b",), ("zz",)], "p string")
    got = [r.p_code for r in FE.ordinal_encode(train, score, ["p"]).collect()]
    assert got == [1, -1]


def test_schema_validation(spark):
    df = spark.createDataFrame([(1, "x")], "a bigint, b string")
    rows = {r.column_name: r.status for r in
            Q.validate_schema(df, {"a": "bigint", "b": "double", "c": "int"}).collect()}
    assert rows == {"a": "PASSED", "b": "FAILED", "c": "FAILED", "__overall__": "FAILED"}
    assert [r.column_name for r in Q.missing_required_columns(df, ["a", "z"]).collect()] == ["z"]


def test_value_counts_share(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    got = {r.value: (r["count"], r.share_pct) for r in A.value_counts(df, "v").collect()}
    assert got["a"][0] == 2 and abs(got["a"][1] - 200 / 3) < 1e-9


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "customerid")
    train, test = FE.train_test_split(df)
    assert train.count() + test.count() == 1000
    assert train.join(test, "customerid").count() == 0
    again = FE.train_test_split(df.repartition(7))[1]
    assert sorted(r.customerid for r in test.collect()) == sorted(r.customerid for r in again.collect())
    assert 150 <= test.count() <= 250


def test_revenue_by_dimension_sums_to_total(spark):
    from kohort.plans import catalog
    catalog.load_all()
    total = catalog.QUERIES["invoice_totals"](spark, "/root/testdata/sf0.001").first().total_revenue
    for name in ("revenue_by_plan", "revenue_by_contract", "revenue_by_active"):
        s = catalog.QUERIES[name](spark, "/root/testdata/sf0.001").agg(F.sum("revenue")).first()[0]
        assert abs(s - total) < 1e-6 * total
