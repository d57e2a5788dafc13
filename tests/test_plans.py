"""Plan shape of every registered query (sf0.001), with the plans of the
tables that it writes while it is built: no nested-loop or cartesian joins,
no Python UDF operators, a window without partition keys (one task) only
where its input is bounded by the calendar, no aggregate that sorts its
input, and column pruning down to every Parquet scan of an input table."""

from __future__ import annotations

import sys

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL

from kohort.plans import catalog
from kohort.sources import files

catalog.load_all()

FORBIDDEN = {"BroadcastNestedLoopJoinExec", "CartesianProductExec",
             "BatchEvalPythonExec", "ArrowEvalPythonExec"}
SORTED = "SortAggregateExec"
# pivots of small results collect strings or structs per group
SORTED_OK: set[str] = set()
# inputs of one row per calendar month (C12) or per cohort index
SINGLE_TASK_WINDOW_OK = {"monthly_churn_rate", "retention_drop"}
# queries whose output needs every column of a scanned table (every invoice
# field derives from one of the six ``orders`` columns)
FULL_WIDTH_SCAN_OK = {"joined_invoices", "invoice_preview"}


def _nodes(plan):
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.executedPlan())
        return
    if kind.endswith("QueryStageExec"):  # executed adaptive plans: stages wrap their plan
        yield plan
        yield from _nodes(plan.plan())
        return
    yield plan
    for seq in (plan.children(), plan.subqueries()):
        for i in range(seq.size()):
            yield from _nodes(seq.apply(i))


def _plans(spark, name, monkeypatch):
    """The plans of everything the query writes on the way, and its own."""
    plans = []
    write = files.shared_table

    def watched(df, label):
        plans.append(df._jdf.queryExecution().executedPlan())
        return write(df, label)

    for module in list(sys.modules.values()):
        if getattr(module, "shared_table", None) is write and module.__name__.startswith("kohort.") \
                and not module.__name__.startswith("kohort.llm"):
            monkeypatch.setattr(module, "shared_table", watched)
    df = catalog.QUERIES[name](spark, SF_SMALL)
    return [*plans, df._jdf.queryExecution().executedPlan()]


def _check(spark, name, monkeypatch):
    nodes = [n for p in _plans(spark, name, monkeypatch) for n in _nodes(p)]
    kinds = {n.getClass().getSimpleName() for n in nodes}
    assert not kinds & FORBIDDEN, kinds & FORBIDDEN
    assert SORTED not in kinds or name in SORTED_OK, name
    unpartitioned = [n for n in nodes if n.getClass().getSimpleName() == "WindowExec"
                     and n.partitionSpec().isEmpty()]
    if name not in SINGLE_TASK_WINDOW_OK:
        # windows over a quantile's buckets without groups: at most BUCKETS rows
        assert all("__bucket" in n.orderSpec().toString() for n in unpartitioned), name
    scans = 0
    for n in nodes:
        if n.getClass().getSimpleName() != "FileSourceScanExec":
            continue
        path = n.relation().location().rootPaths().apply(0).toUri().getPath()
        if not path.startswith(SF_SMALL):
            continue  # a table that the query wrote itself, with the columns it needs
        scans += 1
        if name not in FULL_WIDTH_SCAN_OK:
            assert n.requiredSchema().size() < len(pq.read_schema(path).names), (name, path)
    return scans, kinds


# fitted models end in rows that the driver makes; the stored state writes
# its words itself and is read alone
NO_SCAN_OK = {"feature_importance", "retention_counts_stored", "retention_rate_by_plan_stored"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_shape(spark, name, monkeypatch):
    scans, _ = _check(spark, name, monkeypatch)
    assert scans or name in NO_SCAN_OK, f"{name}: no input scan seen"


LARGE_SHAPE = ["retention_rate_linear", "retention_rate_by_plan", "retention_counts_age", "monthly_churn_rate", "customer_ltv",
               "revenue_by_plan", "clean_customers", "drift_scores", "boxplot_stats", "feature_top_values"]


@pytest.mark.parametrize("name", LARGE_SHAPE)
def test_plan_shape_without_broadcasts(spark, name, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, kinds = _check(spark, name, monkeypatch)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    if name.startswith("retention"):
        assert "ObjectHashAggregateExec" not in kinds
