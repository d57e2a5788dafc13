"""Inputs that the test data never shows: hand-computed answers."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import duckdb
import pytest
from conftest import d

from kohort import config
from kohort.operators import aggregates as A
from kohort.operators import churn as CH
from kohort.operators import cleaning as CL
from kohort.operators import cohorts as C
from kohort.operators import drift as D
from kohort.operators import quality as Q
from kohort.plans import catalog
from kohort.plans import cohort_queries as CQ
from kohort.sources.tables import query_scan

AS_OF = dt.date(2000, 4, 15)
ONE = Decimal("1.00")


@pytest.fixture
def dirty(make_subs):
    return make_subs([
        (1, 1, "A", "x", d("2000-01-05"), None, True),
        (2, 2, "A", "x", d("2000-05-01"), d("2000-02-01"), False),   # ends before it starts
        (3, 3, "A", "x", None, None, True),                          # no start
        (4, 4, "A", "x", d("2000-06-01"), None, True),               # starts after as_of
        (5, None, "A", "x", d("2000-02-10"), d("2000-03-01"), False),
    ])


def test_activity_calendar(dirty):
    got = sorted((r.customer_id, r.activity_month.isoformat()) for r in C.activity_calendar(dirty, AS_OF).collect())
    assert got == [(1, f"2000-0{m}-01") for m in range(1, 5)]


def test_monthly_churn_rate(dirty):
    got = [(r.month.isoformat(), r.active_subscriptions, r.ended_subscriptions, r.churn_rate)
           for r in C.monthly_churn_rate(dirty, AS_OF).orderBy("month").collect()]
    assert got == [("2000-01-01", 1, 0, 0.0), ("2000-02-01", 2, 0, 0.0), ("2000-03-01", 2, 1, 0.5), ("2000-04-01", 1, 0, 0.0)]


def test_calendar_queries_against_duckdb(dirty):
    con = duckdb.connect()
    con.register("subscriptions", dirty.toPandas())
    body = {n: catalog.ORACLE[n].replace(CQ.AS_OF, f"DATE '{AS_OF}'") for n in ("activity_calendar", "monthly_churn_rate")}
    # the registered SQL, over the given subscriptions instead of the mart's
    run = lambda n: con.execute(
        re.sub(r"^WITH subscriptions AS \(.*?\n\),?", "WITH" if n == "monthly_churn_rate" else "", body[n], count=1, flags=re.S)).fetchall()
    want = sorted((int(a), b.isoformat()) for a, b in run("activity_calendar"))
    assert want == sorted((r.customer_id, r.activity_month.isoformat()) for r in C.activity_calendar(dirty, AS_OF).collect())
    rates = {m.isoformat(): (a, e, c) for m, a, e, c in run("monthly_churn_rate")}
    assert rates == {r.month.isoformat(): (r.active_subscriptions, r.ended_subscriptions, r.churn_rate)
                     for r in C.monthly_churn_rate(dirty, AS_OF).collect()}


def test_retention_on_odd_rows(make_inv, make_subs):
    subs = make_subs([(1, 1, "A", "x", d("2000-01-01"), None, True), (2, 1, "B", "x", d("2000-01-01"), None, True),
                      (3, 2, "A", "x", d("2000-01-01"), None, True), (4, None, "A", "x", d("2000-01-01"), None, True)])
    inv = make_inv([(1, 1, d("1999-11-30"), ONE, False, "Paid"), (2, 2, d("2010-01-01"), ONE, False, "Paid"),
                    (3, 3, None, ONE, False, "Paid"), (4, 4, d("2000-01-01"), ONE, False, "Paid"),
                    (5, 1, d("1999-11-01"), ONE, False, "Paid"), (6, 99, d("2000-01-01"), ONE, False, "Paid")])
    got = [(r.cohort_month.isoformat(), r.cohort_index, r.num_customers) for r in C.retention_counts(inv, subs).collect()]
    assert got == [("1999-11-01", 1, 1), ("1999-11-01", 123, 1)]  # months in three words of the bitmap
    by_plan = [(r.subscription_type, r.cohort_index) for r in C.retention_rates_by_plan(inv, subs).collect()]
    assert by_plan == [("A", 1)]
    assert C.retention_counts(inv.where("invoice_id = 3"), subs).count() == 0
    with pytest.raises(Exception, match="outside the matrix"):
        C.retention_matrix(C.retention_rates(inv, subs), list(range(1, 13))).collect()


def test_column_without_values_has_drifted(spark):
    ref = spark.createDataFrame([(float(i), float(i)) for i in range(20)], "a double, b double")
    cur = spark.createDataFrame([(float(i), None) for i in range(20)], "a double, b double")
    got = {r.column_name: (r.drift_score, r.drift_detected) for r in D.numeric_drift(ref, cur, ["a", "b"]).collect()}
    assert got == {"a": (0.0, False), "b": (float("inf"), True)}
    back = {r.column_name: r.drift_score for r in D.numeric_drift(cur, ref, ["a", "b"]).collect()}
    assert back["b"] == float("inf")
    none = cur.select("b")
    assert D.numeric_drift(none, none, ["b"]).first().drift_score == 0.0
    binned = {r.column_name: (r.ks, r.psi) for r in D.binned_drift(ref, cur, ["a", "b"]).collect()}
    assert binned["a"] == (0.0, 0.0) and binned["b"][0] == 1.0 and binned["b"][1] > 1
    assert {r.column_name: r.ks for r in D.binned_drift(cur, ref, ["a", "b"]).collect()}["b"] == 1.0


def test_kpis_without_rows(make_subs, make_inv):
    got = {r.metric: r.value for r in CH.kpi_summary(make_subs([]), make_inv([])).collect()}
    assert got["Total Revenue"] == 0.0 and got["Average Invoice Amount"] is None and len(got) == 11


def test_unknown_plan_gets_a_column(make_subs):
    subs = make_subs([(1, 1, "A", "x", d("2000-01-05"), None, True), (2, 2, "9-NEW", "x", d("2000-01-05"), None, True)])
    got = A.pivot_counts(subs, "start_date", "subscription_type").first().asDict()
    assert got["A"] == got["9-NEW"] == 1


def test_any_churn_label_gets_its_columns(spark):
    rows = [("A", 0, 1.0), ("A", 1, 2.0), ("A", 2, 4.0)]
    got = CH.churn_by_plan_series(spark.createDataFrame(rows, "subscription_type string, churn int, support_calls double"))
    assert got.first()["median_support_calls_2"] == 4.0


def test_empty_bins_are_there(spark):
    df = spark.createDataFrame([(0.0, 0), (10.0, 1), (10.0, 1)], "x double, g int")
    plain = [(r.bin, r["count"]) for r in A.histogram(df, ["x"], 5).orderBy("bin").collect()]
    assert plain == [(1, 1), (2, 0), (3, 0), (4, 0), (5, 2)]
    split = {(r.g, r.bin): r["count"] for r in A.histogram(df, ["x"], 2, by="g").collect()}
    assert split == {(0, 1): 1, (0, 2): 0, (1, 1): 0, (1, 2): 2}


def test_clean_types_do_not_depend_on_the_data(spark):
    schema = "customerid long, age int, subscription_type string"
    full = CL.clean(spark.createDataFrame([(1, 20, "A"), (2, 30, "B")], schema))
    gaps = CL.clean(spark.createDataFrame([(1, 20, "A"), (2, None, None)], schema))
    assert full.schema.simpleString() == gaps.schema.simpleString() == "struct<customerid:bigint,age:double,subscription_type:string>"
    assert {(r.age, r.subscription_type) for r in gaps.collect()} == {(20.0, "A"), (20.0, config.CATEGORY_FILL)}


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0), (None, 1.0, 5.0)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.corr for r in A.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == got["b", "a"] == 1.0 and got["a", "c"] is None and got["c", "c"] is None and len(got) == 9


def test_quality_report_rounds(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    got = {(r.section, r.item): r.value for r in Q.quality_report(df).collect()}
    assert got["overview", "duplicate_pct"] == got["missing", "missing_pct"] == 33.33
    assert got["missing_by_column", "b"] == 2 and ("missing_by_column", "a") not in got
    assert got["unique_values", "a"] == 2 and got["unique_values", "b"] == 1


def test_latest_plan_of_a_day(spark, tmp_path):
    """Two orders on the last day: the larger order key decides the plan."""
    from kohort.sources import mart
    from kohort.sources.tables import Tables

    day = dt.datetime(2000, 1, 1)
    tables = {
        "orders": ([(1, 7, "F", 1.0, day, "2-HIGH"), (9, 7, "F", 1.0, day, "1-URGENT"), (5, 7, "F", 1.0, dt.datetime(1999, 1, 1), "5-LOW")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([], "l_orderkey long, l_shipdate timestamp_ntz"), "events": ([], "user_id long, event_type string"),
        "customer": ([(7, "BUILDING")], "c_custkey long, c_mktsegment string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    row = mart.customers(Tables(spark, str(tmp_path))).first()
    assert (row.subscription_type, row.usage_frequency, row.churn) == ("1-URGENT", 3.0, 1)


def test_query_scan_leaves_the_callers_views(spark):
    mine = spark.range(3)
    mine.createOrReplaceTempView("invoices")
    got = query_scan(spark, "SELECT count(*) + :k AS n FROM {invoices}", {"invoices": spark.range(5)}, {"k": 2})
    assert got.first().n == 7 and spark.table("invoices").count() == 3
    spark.catalog.dropTempView("invoices")
