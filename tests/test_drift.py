"""Drift operators (D2-D6) on micro tables with hand-computed answers."""

from __future__ import annotations

import math

import pytest

from kohort.operators import drift as D

SCHEMA = "age double, tenure double, churn int"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_self_drift_is_zero(spark):
    rows = [(float(a), float(a % 7), a % 2) for a in range(40)]
    df = _frame(spark, rows)
    cols = ["age", "tenure"]
    report = D.drift_alerts(D.drift_report(df, df, cols)).collect()
    assert {r.column_name for r in report} == {"age", "tenure", "churn"}
    assert all(r.drift_score == 0.0 and not r.drift_detected and not r.alert for r in report)
    binned = D.binned_drift(df, df, cols).collect()
    assert all(r.ks == 0.0 and r.psi == 0.0 for r in binned)


def test_shift_and_label_drift_hand_computed(spark):
    # reference 0, 1, 2, 3 (population std sqrt(1.25)); current shifted by
    # one: every quantile moves by 1, so W1 = 1
    ref = _frame(spark, [(0.0, 1.0, 0), (1.0, 1.0, 1), (2.0, 1.0, 0), (3.0, 1.0, 1)])
    cur = _frame(spark, [(1.0, 1.0, 1), (2.0, 1.0, 1), (3.0, 1.0, 1), (4.0, 1.0, 1)])
    got = {r.column_name: r for r in D.drift_report(ref, cur, ["age", "tenure"]).collect()}
    assert got["age"].drift_score == pytest.approx(1 / math.sqrt(1.25), abs=1e-6)
    assert got["age"].drift_detected
    # a constant column that stays constant: no drift, no division error
    assert got["tenure"].drift_score == 0.0 and not got["tenure"].drift_detected
    # label shares (1/2, 1/2) against (1, 0): JS distance, base 2
    m = (0.75, 0.25)
    kl_p = 0.5 * math.log2(0.5 / m[0]) + 0.5 * math.log2(0.5 / m[1])
    kl_q = 1.0 * math.log2(1.0 / m[0])
    assert got["churn"].stat_test == "jensenshannon"
    assert got["churn"].drift_score == pytest.approx(math.sqrt(0.5 * kl_p + 0.5 * kl_q), abs=1e-6)


def test_constant_reference_that_moves_is_total_drift(spark):
    ref = _frame(spark, [(5.0, 1.0, 0)] * 4)
    cur = _frame(spark, [(6.0, 1.0, 0)] * 4)
    got = {r.column_name: r for r in D.numeric_drift(ref, cur, ["age"]).collect()}
    assert math.isinf(got["age"].drift_score) and got["age"].drift_detected


def test_counters(spark):
    ref = _frame(spark, [(0.0, 1.0, 0), (1.0, None, 1), (2.0, 1.0, 0)])
    cur = _frame(spark, [(9.0, 1.0, 1), (8.0, None, 1), (None, 1.0, 1)])
    report = D.drift_report(ref, cur, ["age", "tenure"])
    row = D.dataset_counters(report, cur).collect()[0]
    assert (row.monitored_columns, row.rows, row.columns, row.missing_values) == (3, 3, 3, 2)
    assert row.drifted_columns == sum(r.drift_detected for r in report.collect())
