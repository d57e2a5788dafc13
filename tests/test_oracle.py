"""Every registered query against its DuckDB oracle (sf0.001), and the
rows-only queries for sensible rows and a stable schema."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from oracle_util import compare, duck_connection

from kohort.plans import catalog

catalog.load_all()
WITH_ORACLE = sorted(catalog.ORACLE)
ROWS_ONLY = sorted(set(catalog.QUERIES) - set(catalog.ORACLE))


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_oracle_equal(spark, con, name):
    res = compare(spark, con, catalog.QUERIES[name], catalog.ORACLE[name], SF_SMALL)
    assert res["columns_match"], (res["spark_cols"], res["oracle_cols"])
    assert res["spark_rows"] == res["oracle_rows"]
    assert res["types_match"], (res["spark_types"], res["oracle_types"])
    assert res["exact"], res


def _probability(rows):
    return all(0.0 <= r.churn_probability <= 1.0 for r in rows) and {r.risk_category for r in rows} <= {"High", "Medium", "Low"}


# what must hold for the queries that SQL cannot repeat (fitted models)
SENSIBLE = {
    "feature_importance": lambda rows: len(rows) == 9 and abs(sum(r.importance for r in rows) - 1) < 1e-6,
    "churn_scores": lambda rows: _probability(rows) and len({r.customerid for r in rows}) == len(rows) > 100,
    "drift_sketch_scores": lambda rows: len(rows) == 7 and all(r.drift_score >= 0 and r.error_bound >= 0 for r in rows),
    "model_confusion": lambda rows: 1 <= len(rows) <= 4 and sum(r["count"] for r in rows) > 10,
    "model_recall_f1": lambda rows: rows[0].tp + rows[0].fp + rows[0].fn + rows[0].tn > 10,
    "logreg_recall_f1": lambda rows: rows[0].tp + rows[0].fp + rows[0].fn + rows[0].tn > 10,
    "declared_forest_recall_f1": lambda rows: rows[0].tp + rows[0].fp + rows[0].fn + rows[0].tn > 10,
}


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_runs(spark, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    assert SENSIBLE[name](df.collect()), name


def test_every_customer_is_scored(spark):
    scored = catalog.QUERIES["churn_scores"](spark, SF_SMALL).count()
    assert scored == catalog.QUERIES["risk_bands"](spark, SF_SMALL).count()


def test_high_risk_shows_something(spark):
    rows = catalog.QUERIES["high_risk_customers"](spark, SF_SMALL).collect()
    assert 0 < len(rows) <= 10 and all(r.churn_probability >= 0.7 for r in rows)
    assert [(-r.churn_probability, r.customerid) for r in rows] == sorted((-r.churn_probability, r.customerid) for r in rows)


ORDERED = {
    "customer_ltv": lambda r: (-r.lifetime_value, r.customer_id),
    "value_counts_plan": lambda r: (-r["count"], r.value),
    "subs_count_of_counts": lambda r: r.subscriptions,
    "revenue_by_plan": lambda r: (-r.revenue, r.subscription_type),
    "feature_top_values": lambda r: (r.feature, r.rank),
    "cohort_curve": lambda r: r.cohort_index,
    "top_customers": lambda r: (-r.lifetime_value, r.customer_id),
    "retention_rate_linear": lambda r: (r.cohort_month, r.cohort_index),
    "retention_counts_linear": lambda r: (r.cohort_month, r.cohort_index),
    "retention_rate_by_plan": lambda r: (r.subscription_type, r.cohort_month, r.cohort_index),
    "cohort_acquisition": lambda r: (r.acquisition_month, r.customer_id),
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_order(spark, name):
    """O1, O2: the final order, with the key as tie-break."""
    keys = [ORDERED[name](r) for r in catalog.QUERIES[name](spark, SF_SMALL).collect()]
    assert keys and keys == sorted(keys)


def test_every_query_has_a_survey_id():
    assert set(catalog.SURVEY_IDS) == set(catalog.QUERIES)


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(catalog.ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_churn_scores_use_the_pipeline_forest(spark, monkeypatch):
    from kohort.operators import model as M

    fitted = []
    monkeypatch.setattr(M, "fit", lambda train, *estimator: fitted.append(estimator))
    monkeypatch.setattr(M, "score", lambda model, full: full)
    catalog.QUERIES["churn_scores"](spark, SF_SMALL)
    assert fitted == [()]
