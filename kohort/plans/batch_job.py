"""The end-to-end churn job: extract, validate, clean and split, fit or
reuse the model, evaluate, monitor drift, write the report.

Every stage is a Spark job over the whole input; the report is a small
long table ``(section, item, value)`` written as JSON (S5).  Lineage is cut
by tables written to the shared folder that the session names in
``spark.checkpoint.dir``; a lost executor then reads those, not the raw
tables.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import cleaning as CL
from ..operators import drift as D
from ..operators import features as FE
from ..operators import model as M
from ..operators import quality as Q
from ..session import checkpoint_dir, configure, input_bytes, size_for_input
from ..sources import files, mart
from ..sources.files import shared_table
from ..sources.tables import Tables, table_path

REQUIRED = (config.NUMERICAL_FEATURES + config.ORDINAL_FEATURES
            + [config.TARGET_COLUMN, config.CUSTOMER_ID_COLUMN])


def _metric_rows(spark: SparkSession, section: str, values: dict) -> DataFrame:
    rows = [(section, k, float(v) if v is not None else None) for k, v in values.items()]
    return spark.createDataFrame(rows, "section string, item string, value double")


def run_churn_job(spark: SparkSession, sf_dir: str, out_dir: str,
                  cutoff: _dt.date = config.CUTOFF,
                  reference_cutoff: _dt.date = config.REFERENCE_CUTOFF,
                  search_args: dict | None = None) -> dict:
    """Run all stages; return the paths written and the headline metrics.

    ``search_args`` go to the random search, which runs when ``out_dir``
    holds neither a fitted model nor a best estimator."""
    configure(spark)
    checkpoint_dir(spark)
    t = Tables(spark, sf_dir)
    # partitions sized from the input (metadata only)
    size_for_input(spark, input_bytes(spark, [table_path(sf_dir, n) for n in
                                              ("orders", "lineitem", "customer", "events")]))

    # 1 extract + validate (Q1) + summary (Q3)
    customers = mart.customers(t, cutoff)
    if not Q.has_required_columns(customers, REQUIRED):
        missing = [r.column_name for r in Q.missing_required_columns(customers, REQUIRED).collect()]
        raise ValueError(f"data validation failed, missing columns: {missing}")
    summary_path = files.write_table(Q.data_summary(customers), os.path.join(out_dir, "data_summary"))

    # 2 dedupe, split by key, medians from the training rows only
    deduped = shared_table(customers.dropDuplicates(), "customers")
    meds = shared_table(CL.fit_medians(FE.train_test_split(deduped)[0], config.NUMERICAL_FEATURES), "medians")
    full = shared_table(CL.apply_medians(deduped, meds, config.NUMERICAL_FEATURES).fillna(
        config.CATEGORY_FILL, config.ORDINAL_FEATURES), "model-input")
    train, test = FE.train_test_split(full)

    # 3 reuse, refit or search (M11), evaluate on the test split (M8), score
    # every customer (M9) and save the scores
    model_dir = os.path.join(out_dir, "models")
    M.save_unfitted(model_dir)
    model = M.reuse_or_fit(spark, train, model_dir, **(search_args or {}))
    metrics = M.recall_f1(M.score(model, test)).first().asDict()
    scores = M.score(model, full)
    pred_path = files.write_table(scores, os.path.join(out_dir, "predictions"))

    # 4 monitor: reference vs current snapshot
    ref, cur = (D.snapshot(c) for c in mart.customer_snapshots(t, [reference_cutoff, cutoff]))
    alerts = D.drift_alerts(D.drift_report(ref, cur))
    drift_path = files.write_table(alerts, os.path.join(out_dir, "drift"))
    n_alerts = spark.read.parquet(drift_path).where(F.col("alert")).count()

    # 5 report (S5)
    report = (_metric_rows(spark, "model_performance",
                           {"recall": metrics["recall"], "f1": metrics["f1"],
                            "precision": metrics["precision"]})
              .unionByName(_metric_rows(spark, "monitoring", {"high_drift_alerts": n_alerts}))
              .unionByName(spark.read.parquet(drift_path).select(
                  F.lit("drift_score").alias("section"), F.col("column_name").alias("item"),
                  F.col("drift_score").alias("value"))))
    report_path = files.write_report(report, os.path.join(out_dir, "report"))
    return {"summary": summary_path, "predictions": pred_path, "drift": drift_path,
            "report": report_path, "recall": metrics["recall"], "f1": metrics["f1"],
            "alerts": n_alerts}
