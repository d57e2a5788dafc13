"""The top levels of the forest: rounds for all large nodes at once, own thresholds, scoring by shares of the trees."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from kohort.operators import deep_forest as D


def frame(spark, x, y):
    names = [f"c{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, x[i]), int(y[i])) for i in range(len(x))]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in names) + ", churn int")
    return VectorAssembler(inputCols=names, outputCol="features").transform(df)


def noisy(n, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 3))
    return x, ((x[:, 0] * x[:, 1] + rng.normal(0, 0.4, n)) > 0).astype(int)


def scores(model, df, **kw):
    return {r.id: r.p for r in model.score(df, out="p", **kw).select("id", "p").collect()}


def test_large_nodes_share_their_rounds(spark, monkeypatch):
    """Neither the placed rows are written nor does each large leaf have a fit of its own."""
    written, keep = [], D.shared_table
    monkeypatch.setattr(D, "shared_table", lambda df, name: written.append(name) or keep(df, name))
    x = np.exp(np.random.default_rng(4).normal(0, 3, (1200, 2)))
    df = frame(spark, x, np.sin(40 * x[:, 0]) > 0)
    model = D.DeepForest(trees=6, seed=2, node_rows=80).fit(df, "churn", "id")
    assert written == ["forest-rows", "forest"]
    assert sum(len(r) for r in model.rounds) > 3 * len(model.rounds)
    drawn = df.select(F.explode(F.sequence(F.lit(0), F.lit(5))).alias("tree"), "id").withColumn("w", D.bootstrap_count(2, F.col("tree"), F.col("id")))
    total = {r.tree: r.w for r in drawn.groupBy("tree").agg(F.sum("w").alias("w")).collect()}
    roots = model.nodes().where("node = 0").groupBy("tree").agg(F.sum("weight").alias("w")).collect()
    assert {r.tree: r.w for r in roots} == total  # every drawn row is in one subtree


def test_large_pure_nodes_are_closed(spark):
    rng = np.random.default_rng(1)
    x = np.column_stack([np.repeat([0.0, 1.0], 500), rng.normal(0, 1, 1000)])
    y = np.where(x[:, 0] == 0, 0, rng.integers(0, 2, 1000))
    df = frame(spark, x, y)
    model = D.DeepForest(trees=3, seed=1, features=2, node_rows=100).fit(df, "churn", "id")
    assert any(ones == 0 and total > 100 for total, ones in model.closed.values())
    got = scores(model, df)
    assert all(got[i] == 0 for i in range(500))


def test_nodes_that_the_bins_cannot_split(spark):
    """Nodes smaller than a bin get thresholds from their own rows; equal rows stay one leaf."""
    x, y = noisy(1500, 5)
    model = D.DeepForest(trees=1, seed=3, features=3, node_rows=12).fit(frame(spark, x, y), "churn", "id")
    small = model.subtrees.select("path", F.element_at("weight", 1).alias("w"), F.size("feature").alias("n")).collect()
    assert all(r.w <= 12 * 8 for r in small if r.n > 1) and len(small) > 64  # a leaf of one class may be large
    same = frame(spark, np.ones((300, 2)), np.arange(300) % 3 == 0)
    one = D.DeepForest(trees=2, seed=3, node_rows=50).fit(same, "churn", "id")
    assert one.nodes().count() == 2 and len(set(scores(one, same).values())) == 1


def test_depth_limit_below_the_rounds(spark):
    x, y = noisy(1500, 6)
    df = frame(spark, x, y)
    model = D.DeepForest(trees=300, seed=3, max_depth=4, min_leaf=2, node_rows=400).fit(df.where("id < 900"), "churn", "id")

    def depth(tree, at=0):
        return 0 if tree["feature"][at] < 0 else 1 + max(depth(tree, tree["left"][at]), depth(tree, tree["right"][at]))
    trees = D._joined_trees(model._packed().toArrow(), model.top)
    assert model.top is not None and len(trees) == 300 and max(depth(t) for _, t in trees) == 4
    got = scores(model, df.where("id >= 900"))
    assert np.mean([(p > 0.5) == y[i] for i, p in got.items()]) > 0.65


@pytest.mark.parametrize("node_rows", [10_000, 100])
def test_shares_of_the_trees(spark, monkeypatch, node_rows):
    """Blocks of a few rows and a share per tree give the sent forest's scores."""
    x, y = noisy(400, 7)
    df = frame(spark, x, y)
    model = D.DeepForest(trees=7, seed=4, node_rows=node_rows).fit(df, "churn", "id")
    sent = scores(model, df)
    monkeypatch.setattr(D, "_TREES_BYTES", 4000)
    monkeypatch.setattr(D, "_BATCH_ROWS", 9)
    assert scores(model, df, broadcast_bytes=0) == sent


def test_counts_are_the_bootstrap(spark):
    got = spark.range(3000).select(F.xxhash64(F.lit(7), F.lit(3), "id").alias("h"), D.bootstrap_count(7, F.lit(3), F.col("id")).alias("n")).toPandas()
    assert (D._counts(got.h.to_numpy()) == got.n.to_numpy()).all()
