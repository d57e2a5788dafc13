"""Cohort and retention rules on hand-computed micro tables (FIXTURES §4)."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from conftest import d

from kohort.operators import cohort_state
from kohort.operators import cohorts as C


def _sub(sid, cust, plan="A", start="2020-01-01"):
    return (sid, cust, plan, "M", d(start), None, True)


def _inv(iid, sid, day):
    return (iid, sid, d(day), Decimal("10.00"), False, "Paid")


def test_month_wrap_linear_and_age(make_subs, make_inv):
    subs = make_subs([_sub(10, 1)])
    inv = make_inv([_inv(i, 10, day) for i, day in
                    enumerate(["2020-01-05", "2020-12-05", "2021-01-05", "2021-02-05"])])
    lin = sorted(r.cohort_index for r in C.cohort_index_rows(inv, subs, "linear").collect())
    age = sorted(r.cohort_index for r in C.cohort_index_rows(inv, subs, "age").collect())
    assert lin == [1, 12, 13, 14]
    assert age == sorted([1, 12, 1, 2])


def test_same_month_twice(make_subs, make_inv):
    subs = make_subs([_sub(10, 1)])
    inv = make_inv([_inv(1, 10, "2020-01-05"), _inv(2, 10, "2020-01-20")])
    assert C.cohort_index_rows(inv, subs).count() == 2
    counts = C.retention_counts(inv, subs).collect()
    assert [(r.cohort_index, r.num_customers) for r in counts] == [(1, 1)]


def test_plan_switch_drops_pair_without_size(make_subs, make_inv):
    subs = make_subs([_sub(10, 1, "A"), _sub(11, 1, "B")])
    inv = make_inv([_inv(1, 10, "2020-01-05"), _inv(2, 11, "2020-02-05")])
    rows = C.retention_rates_by_plan(inv, subs).collect()
    assert [(r.subscription_type, r.cohort_index) for r in rows] == [("A", 1)]


def test_late_joiner_rate_above_one(make_subs, make_inv):
    # customer 1 on plan A from month 0; customer 2 starts on B in month 0
    # and uses A in month 1: plan A size 1, two A customers at index 2
    subs = make_subs([_sub(10, 1, "A"), _sub(20, 2, "B"), _sub(21, 2, "A")])
    inv = make_inv([_inv(1, 10, "2020-01-05"), _inv(2, 20, "2020-01-06"),
                    _inv(3, 10, "2020-02-05"), _inv(4, 21, "2020-02-06")])
    rows = {(r.subscription_type, r.cohort_index): r.retention_rate
            for r in C.retention_rates_by_plan(inv, subs).collect()}
    assert rows[("A", 2)] == 2.0


def test_half_up_rounding(make_subs, make_inv):
    subs = make_subs([_sub(100 + i, i) for i in range(16)])
    inv = make_inv([_inv(i, 100 + i, "2020-01-05") for i in range(16)] + [_inv(99, 100, "2020-02-05")])
    rates = {r.cohort_index: r.retention_rate for r in C.retention_rates(inv, subs).collect()}
    assert rates == {1: 1.0, 2: 0.063}


def test_null_customer_has_no_cohort(make_subs, make_inv):
    subs = make_subs([_sub(10, None), _sub(11, 2)])
    inv = make_inv([_inv(1, 10, "2020-01-05"), _inv(2, 11, "2020-03-05")])
    got = [(r.customer_id, r.cohort_month) for r in C.first_invoice_cohorts(inv, subs).collect()]
    assert got == [(2, d("2020-03-01"))]
    acq = [r.customer_id for r in C.acquisition_cohorts(subs).collect()]
    assert acq == [2]


def test_empty_input_gives_empty_rates(make_subs, make_inv):
    rates = C.retention_rates(make_inv([]), make_subs([]))
    assert rates.count() == 0
    assert C.monthly_churn_rate(make_subs([])).count() >= 0


def test_activity_calendar_and_churn_rate(make_subs):
    subs = make_subs([
        (1, 1, "A", "M", d("2001-05-10"), d("2001-06-20"), False),
        (2, 2, "A", "M", d("2001-06-01"), None, True),
    ])
    cal = sorted((r.customer_id, r.activity_month) for r in C.activity_calendar(subs).collect())
    assert cal == [(1, d("2001-05-01")), (1, d("2001-06-01")),
                   (2, d("2001-06-01")), (2, d("2001-07-01")), (2, d("2001-08-01"))]
    rate = {r.month: (r.active_subscriptions, r.ended_subscriptions, r.churn_rate)
            for r in C.monthly_churn_rate(subs).collect()}
    assert rate[d("2001-05-01")] == (1, 0, 0.0)
    assert rate[d("2001-06-01")] == (2, 1, 0.5)
    assert rate[d("2001-08-01")] == (1, 0, 0.0)


def test_rate_at_index_one_is_one(spark):
    from kohort.plans import catalog
    catalog.load_all()
    for name in ("retention_rate_linear", "retention_rate_age"):
        df = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        vals = {r.retention_rate for r in df.where("cohort_index = 1").collect()}
        assert vals == {1.0}


def test_cohort_sizes_sum_to_customers(spark):
    from pyspark.sql import functions as F

    from kohort.plans import catalog
    catalog.load_all()
    rates = catalog.QUERIES["retention_rate_linear"](spark, "/root/testdata/sf0.001")
    sizes = rates.where("cohort_index = 1").agg(F.sum("cohort_size")).first()[0]
    cohorts = catalog.QUERIES["cohort_first_invoice"](spark, "/root/testdata/sf0.001").count()
    assert sizes == cohorts


def test_age_counts_not_above_linear_sums(spark):
    from pyspark.sql import functions as F

    from kohort.plans import catalog
    catalog.load_all()
    lin = catalog.QUERIES["retention_counts_linear"](spark, "/root/testdata/sf0.001")
    age = catalog.QUERIES["retention_counts_age"](spark, "/root/testdata/sf0.001")
    folded = (lin.withColumn("cohort_index", F.pmod(F.col("cohort_index") - 1, F.lit(12)) + 1)
              .groupBy("cohort_month", "cohort_index").agg(F.sum("num_customers").alias("s")))
    bad = age.join(folded, ["cohort_month", "cohort_index"]).where("num_customers > s").count()
    assert bad == 0


def _brute(pairs, mode, plan=None):
    """(cohort month, index) -> customers, from (customer, plan, date)."""
    first, out = {}, {}
    for c, _, day in pairs:
        m = day.year * 12 + day.month
        first[c] = min(first.get(c, m), m)
    for c, p, day in pairs:
        if plan is None or p == plan:
            since = day.year * 12 + day.month - first[c]
            month = d(f"{(first[c] - 1) // 12:04d}-{(first[c] - 1) % 12 + 1:02d}-01")
            out.setdefault((month, since + 1 if mode == "linear" else since % 12 + 1), set()).add(c)
    return {k: len(v) for k, v in out.items()}


def _scattered(seed, years):
    rng = random.Random(seed)
    subs = [(10 * c + k, c, "AB"[k]) for c in range(12) for k in range(2)]
    rows = [(s, c, p, d(f"{rng.choice(years):04d}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}")) for s, c, p in subs for _ in range(6)]
    return subs, rows


@pytest.mark.parametrize("mode", ["linear", "age"])
@pytest.mark.parametrize("years", [[2020], [2019, 2020, 2021], [1, 1995, 2020, 9999], [1, 9999]])
def test_counts_for_any_dates(make_subs, make_inv, mode, years):
    subs, rows = _scattered(len(years), years)
    subs_df = make_subs([_sub(s, c, p) for s, c, p in subs])
    inv_df = make_inv([_inv(i, s, day.isoformat()) for i, (s, _, _, day) in enumerate(rows)] + [(999, 10, None, Decimal("1.00"), False, "Paid")])
    pairs = [(c, p, day) for _, c, p, day in rows]
    got = {(r.cohort_month, r.cohort_index): r.num_customers for r in C.retention_counts(inv_df, subs_df, mode).collect()}
    assert got == _brute(pairs, mode)
    by_plan = C.retention_rates_by_plan(inv_df, subs_df, mode).collect()
    for plan in "AB":
        want = _brute(pairs, mode, plan)
        want = {k: n for k, n in want.items() if (k[0], 1) in want}
        assert {(r.cohort_month, r.cohort_index): r.num_customers for r in by_plan if r.subscription_type == plan} == want


def test_plan_width_does_not_follow_the_dates(make_subs, make_inv):
    def width(*days):
        df = C.retention_rates(make_inv([_inv(i, 10, day) for i, day in enumerate(days)]), make_subs([_sub(10, 1)]))
        return len(df._jdf.queryExecution().optimizedPlan().toString())
    assert abs(width("2020-01-05", "2020-02-05") - width("0001-01-01", "9999-12-31")) < 50  # expression ids only


def test_stored_words(spark, make_subs, make_inv, tmp_path):
    """Batches in any order, one of them twice, with and without compaction: the full run's counts."""
    subs, rows = _scattered(5, [1999, 2000, 2001])
    subs_df = make_subs([_sub(s, c, p) for s, c, p in subs])
    inv = [_inv(i, s, day.isoformat()) for i, (s, _, _, day) in enumerate(rows)]
    batches = [make_inv(inv[k::3]) for k in range(3)]
    whole = make_inv(inv)
    for name, order in {"a": [0, 1, 2], "b": [2, 0, 2, 1], "c": [1, 1, "compact", 0, "compact", 2, 0, "compact"]}.items():
        path = str(tmp_path / name)
        assert cohort_state.words(spark, path).count() == 0
        for step in order:
            if step == "compact":
                cohort_state.compact(spark, path)
            else:
                cohort_state.append(batches[step], subs_df, path)
        words = cohort_state.words(spark, path)
        for mode in ("linear", "age"):
            assert C.counts_from_words(words, mode).collect() == C.retention_counts(whole, subs_df, mode).collect()
            assert C.rates_from_words(words, mode).collect() == C.retention_rates(whole, subs_df, mode).collect()
            assert C.plan_rates_from_words(words, mode).collect() == C.retention_rates_by_plan(whole, subs_df, mode).collect()
    assert sorted(p.name for p in (tmp_path / "c").iterdir()) == ["v=2", "v=3"]


def test_unfinished_compaction_is_not_read(spark, make_subs, make_inv, tmp_path):
    path = str(tmp_path / "s")
    subs = make_subs([_sub(10, 1)])
    cohort_state.append(make_inv([_inv(1, 10, "2020-03-05")]), subs, path)
    (tmp_path / "s" / "v=1").mkdir()  # a run that ended before Spark committed it
    cohort_state.append(make_inv([_inv(2, 10, "2020-05-05")]), subs, path)
    assert [r.cohort_index for r in C.counts_from_words(cohort_state.words(spark, path)).collect()] == [1, 3]
    assert cohort_state.compact(spark, path) == 1
    assert cohort_state.words(spark, path).count() == 1
