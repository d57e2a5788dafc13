"""Model persistence, search, other estimators, file sinks and the batch job."""

from __future__ import annotations

import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from kohort import config
from kohort.operators import cleaning as CL
from kohort.operators import model as M
from kohort.plans import profile_queries as PQ
from kohort.plans.batch_job import run_churn_job
from kohort.sources import files, mart
from kohort.sources.tables import Tables


def _frames(spark):
    return PQ._model_frames(Tables(spark, SF_SMALL))[:2]


def test_save_load_equal_predictions(spark, tmpdir_session):
    train, test = _frames(spark)
    model = M.fit(train, M.build_estimator(trees=20))
    path = M.save(model, os.path.join(tmpdir_session, "m1"))
    again = M.load(path)
    a = M.score(model, test).orderBy("customerid").collect()
    b = M.score(again, test).orderBy("customerid").collect()
    assert a == b
    probs = [r.churn_probability for r in a]
    assert all(0.0 <= p <= 1.0 for p in probs)


def test_dictionary_prepares_as_the_encoder_does(spark, tmpdir_session):
    """Same feature vectors as with MLlib's encoder, unseen and null categories too; saved and loaded."""
    train, test = _frames(spark)
    plan, contract = config.ORDINAL_FEATURES
    odd = test.limit(4).withColumn(plan, F.when(F.col("customerid") % 2 == 0, F.lit("nowhere"))).withColumn(contract, F.lit(None).cast("string"))
    rows = test.unionByName(odd.withColumn("customerid", -F.col("customerid")))
    vectors = lambda df: {r.customerid: r.features.toArray().tolist() for r in df.select("customerid", "features").collect()}
    own = M.Preparation.fit(train)
    want = vectors(M.Pipeline(stages=M.preparation()).fit(train).transform(rows))
    assert vectors(own.transform(rows)) == want
    path = os.path.join(tmpdir_session, "prepared")
    own.save(path)
    again = M.Preparation.load(spark, path)
    assert vectors(again.transform(rows)) == want and again.feature_names() == own.feature_names() == config.ORDINAL_FEATURES + config.NUMERICAL_FEATURES


def test_seed_stability(spark):
    train, test = _frames(spark)
    s1 = M.score(M.fit(train, M.build_estimator(trees=10)), test).orderBy("customerid").collect()
    s2 = M.score(M.fit(train, M.build_estimator(trees=10)), test).orderBy("customerid").collect()
    assert s1 == s2


def test_random_search_small(spark):
    train, _ = _frames(spark)
    space = [dict(p, numTrees=10 + i) for i, p in enumerate(M.search_space(2))]
    best, scores, pipeline = M.random_search(train, folds=2, space=space, parallelism=2)
    assert len(scores) == 2
    chosen = max(scores, key=lambda s: s[1])[0]
    assert pipeline.getStages()[-1].getNumTrees() == best.stages[-1].getNumTrees == chosen["numTrees"]
    assert all(0.0 <= s <= 1.0 for _, s in scores)
    assert best.stages[-1].getNumTrees in (10, 11)


def test_halving_finds_the_full_search_s_best(spark):
    """Same draws and folds: the same best draw as the full search, with about half the fits."""
    train, _ = _frames(spark)
    space = [dict(p, numTrees=8, maxDepth=2 + i) for i, p in enumerate(M.search_space(6))]
    _, full, _ = M.random_search(train, folds=4, space=space)
    model, halved, pipeline = M.halving_search(train, folds=4, space=space)
    best = max(range(6), key=lambda i: full[i][1])
    assert max(halved, key=lambda s: s[1])[1] >= full[best][1] - 1e-9
    assert pipeline.getStages()[-1].getMaxDepth() == full[best][0]["maxDepth"]
    assert model.stages[-1].getNumTrees == 8


def test_other_estimators(spark):
    train, test = _frames(spark)
    out = M.score(M.fit(train, M.build_estimator("boosted_trees", maxIter=5)), test)
    assert out.count() == test.count()
    forest = M.build_estimator("declared_forest")
    assert (forest.max_depth, forest.min_leaf, forest.min_split, forest.trees) == (10, 2, 5, 100)
    assert M.build_estimator().max_depth is None


def test_logistic_regression_against_newton(spark):
    """The fitted weights minimise C * (summed log loss) + |w|^2 / 2 (free intercept)."""
    import numpy as np

    train, _ = _frames(spark)
    n = train.count()
    model = M.fit(train, M.build_estimator("logistic_regression", rows=n))
    rows = model.transform(train).select("features", M.LABEL).collect()
    x = np.column_stack([np.array([r.features.toArray() for r in rows]), np.ones(n)])
    y = np.array([r[M.LABEL] for r in rows], float)
    penalty = np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
    fitted = model.stages[-1]
    assert np.allclose(np.append(fitted.coefficients.toArray(), fitted.intercept), w, atol=1e-3)
    with pytest.raises(ValueError):
        M.build_estimator("logistic_regression")


def test_reuse_cascade(spark, tmp_path):
    """Nothing saved is an error; then unfitted -> search, best -> refit, fitted -> as it is."""
    train, test = _frames(spark)
    folder = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        M.reuse_or_fit(spark, train, folder)
    M.save_unfitted(folder)
    space = [dict(p, numTrees=5 + i) for i, p in enumerate(M.search_space(2))]
    first = M.reuse_or_fit(spark, train, folder, folds=2, space=space)
    assert sorted(os.listdir(folder)) == sorted([M.TUNED, M.BEST, M.UNFITTED])
    trees = first.stages[-1].getNumTrees
    again = M.reuse_or_fit(spark, None, folder)  # fitted: the training rows are not needed
    assert M.score(first, test).orderBy("customerid").collect() == M.score(again, test).orderBy("customerid").collect()
    other = str(tmp_path / "other")
    M.save(M.Pipeline.load(os.path.join(folder, M.BEST)), os.path.join(other, M.BEST))
    refit = M.reuse_or_fit(spark, train, other)
    assert refit.stages[-1].getNumTrees == trees and os.path.exists(os.path.join(other, M.TUNED))


def test_importances_need_matching_names(spark):
    train, _ = _frames(spark)
    model = M.build_pipeline(M.build_estimator("search_forest", numTrees=3), numeric=["age", "tenure"], categorical=["contract_length"]).fit(train)
    assert [r.feature for r in M.feature_importance(model, spark).collect()] == ["contract_length", "age", "tenure"]


def test_split_features_target(spark):
    df = spark.createDataFrame([(1, 2, 0)], "customerid int, age int, churn int")
    x, y = CL.split_features_target(df)
    assert (x.columns, y.columns) == (["customerid", "age"], ["customerid", "churn"])


def test_search_space_ranges():
    for p in M.search_space(50):
        assert 100 <= p["numTrees"] < 1000 and 3 <= p["maxDepth"] < 10
        assert 0.5 <= p["subsamplingRate"] <= 1.0
        assert p["featureSubsetStrategy"] in ("sqrt", "log2", "all")


def test_csv_round_trip(spark, tmpdir_session):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, s string")
    path = files.write_table(df, os.path.join(tmpdir_session, "csv1"), fmt="csv")
    back = files.read_csv(spark, path, "id bigint, s string")
    assert sorted(back.collect()) == sorted(df.collect())


def test_batch_job(spark, tmpdir_session):
    search = {"folds": 2, "space": [dict(p, numTrees=10) for p in M.search_space(2)]}
    out = run_churn_job(spark, SF_SMALL, os.path.join(tmpdir_session, "job"), search_args=search)
    rep = files.read_report(spark, out["report"])
    items = {(r.section, r.item) for r in rep.collect()}
    assert ("model_performance", "recall") in items
    drift = spark.read.parquet(out["drift"])
    assert drift.count() == len(config.MONITORING_COLUMNS) + 1
    # second run reuses the saved model
    again = run_churn_job(spark, SF_SMALL, os.path.join(tmpdir_session, "job"))
    assert again["recall"] == out["recall"]
    # every customer is scored, not only the test split
    predictions = spark.read.parquet(out["predictions"])
    assert predictions.where(F.col("churn_probability").isNull()).count() == 0
    assert predictions.count() == mart.customers(Tables(spark, SF_SMALL)).count()
