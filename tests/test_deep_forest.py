"""The forest without a depth limit: growth, placement, scoring, persistence."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from kohort.operators import deep_forest as D


def plain_tree(x, y, w, min_split=2, min_leaf=1, max_depth=None, depth=0):
    """CART on all features, one node at a time: nested (feature, threshold, left, right) or a share."""
    total, ones = w.sum(), (w * y).sum()
    share = ones / total
    if len(x) < min_split or ones in (0, total) or max_depth == depth:
        return share
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for a, b in zip(values[:-1], values[1:]):
            low = x[:, f] <= a
            if min(low.sum(), (~low).sum()) < min_leaf:
                continue
            s = sum((w[m] * y[m]).sum() ** 2 / w[m].sum() + (w[m] * (1 - y[m])).sum() ** 2 / w[m].sum() for m in (low, ~low))
            if best is None or s > best[0]:
                best = (s, f, a + (b - a) / 2, low)
    if best is None:
        return share
    _, f, t, low = best
    kids = [plain_tree(x[m], y[m], w[m], min_split, min_leaf, max_depth, depth + 1) for m in (low, ~low)]
    return (f, t, *kids)


def nested(tree, at=0):
    if tree["feature"][at] < 0:
        return tree["share"][at]
    return (int(tree["feature"][at]), tree["threshold"][at], nested(tree, tree["left"][at]), nested(tree, tree["right"][at]))


def data(n, seed=0, noise=0.5):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 4, n), rng.normal(0, 1, (n, 3)).round(2), np.full(n, 7.0)])
    y = ((x[:, 1] + x[:, 2] * x[:, 3] + rng.normal(0, noise, n)) > 0).astype(float)
    return x, y


@pytest.mark.parametrize("limits", [{}, {"min_split": 6}, {"min_leaf": 3}, {"max_depth": 3}, {"max_depth": 0}])
def test_tree_against_plain_version(limits):
    x, y = data(220, 3)
    w = np.random.default_rng(1).integers(1, 4, 220).astype(float)
    grown = D.grow(x, y, w, 5, k=5, **limits)
    assert nested(grown) == plain_tree(x, y, w, **limits)
    assert grown["weight"][0] == w.sum()


def test_unlimited_depth():
    """Alternating labels along one feature: a tree of the original's kind needs far more than 30 levels."""
    n = 400
    x = np.arange(n, dtype=float)[:, None] ** 2
    y = (np.arange(n) % 2).astype(float)
    tree = D.grow(x, y, np.ones(n), 1, k=1)
    assert (D.walk(x, tree) == y).all()

    def depth(at):
        return 0 if tree["feature"][at] < 0 else 1 + max(depth(tree["left"][at]), depth(tree["right"][at]))
    assert depth(0) > 30


def test_odd_values():
    x = np.array([[np.nan], [np.nan], [1.0], [1.0], [-np.inf], [np.inf]])
    y = np.array([1, 1, 0, 0, 1, 1.0])
    tree = D.grow(x, y, np.ones(6), 0, k=1)
    assert D.walk(x, tree).tolist() == y.tolist()
    same = D.grow(np.ones((5, 2)), np.array([0, 1, 1, 0, 1.0]), np.ones(5), 0, k=2)
    assert same["feature"].tolist() == [-1] and same["share"].tolist() == [0.6]
    close = np.array([[1.0], [np.nextafter(1.0, 2)]])
    assert D.walk(close, D.grow(close, np.array([0, 1.0]), np.ones(2), 0, k=1)).tolist() == [0, 1]


def frame(spark, n, seed=0):
    x, y = data(n, seed)
    rows = [(i, *map(float, x[i]), int(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double, churn int")
    return VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(df)


def scores(model, df, **kw):
    return {r.id: r.p for r in model.score(df, out="p", **kw).select("id", "p").collect()}


def test_bootstrap_counts(spark):
    counts = spark.range(20000).select(D.bootstrap_count(7, F.lit(3), F.col("id")).alias("c")).groupBy("c").count().collect()
    share = {r.c: r["count"] / 20000 for r in counts}
    assert abs(share[0] - 0.368) < 0.02 and abs(share[1] - 0.368) < 0.02 and abs(share[2] - 0.184) < 0.02


@pytest.mark.parametrize("node_rows", [10_000, 150])
def test_same_forest_at_any_partitioning(spark, node_rows):
    df = frame(spark, 700)
    forest = D.DeepForest(trees=8, seed=5, node_rows=node_rows)
    one = scores(forest.fit(df.coalesce(1), "churn", "id"), df)
    many = scores(forest.fit(df.repartition(7, "b"), "churn", "id"), df.repartition(3))
    assert one == many and len(one) == 700


@pytest.mark.parametrize("node_rows", [10_000, 60])
def test_scores_sent_and_joined_are_equal(spark, node_rows):
    df = frame(spark, 500, 2)
    model = D.DeepForest(trees=5, seed=1, node_rows=node_rows).fit(df, "churn", "id")
    assert (model.top is not None) == (node_rows < 500)
    joined = scores(model, df, broadcast_bytes=0)
    assert scores(model, df) == joined
    if model.top is None:
        shares = {}  # the stored nodes, walked in SQL
        nodes = model.nodes().toPandas()
        rows = df.select("id", *"abcde").toPandas()
        con = duckdb.connect()
        con.register("nodes", nodes)
        con.register("inputs", rows)
        value = "CASE n.feature " + " ".join(f"WHEN {i} THEN r.{c}" for i, c in enumerate("abcde")) + " END"
        shares = dict(con.execute(f"""
            WITH RECURSIVE walk AS (
              SELECT r.id, n.tree, n.node FROM inputs r, nodes n WHERE n.node = 0
              UNION ALL
              SELECT w.id, w.tree, CASE WHEN {value} <= n.threshold THEN n."left" ELSE n."right" END
              FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.feature >= 0 JOIN inputs r ON r.id = w.id)
            SELECT w.id, avg(n.share) FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.feature < 0 GROUP BY w.id
        """).fetchall())
        assert shares.keys() == joined.keys() and all(abs(shares[i] - joined[i]) < 1e-12 for i in shares)


def test_large_leaves_are_split_again(spark):
    """Almost all rows fall into one corner: the first levels leave a leaf that is too large."""
    rng = np.random.default_rng(4)
    x = np.exp(rng.normal(0, 3, (1500, 2)))
    y = (np.sin(40 * x[:, 0]) > 0).astype(int)
    df = spark.createDataFrame([(i, float(x[i, 0]), float(x[i, 1]), int(y[i])) for i in range(1500)], "id long, a double, b double, churn int")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = D.DeepForest(trees=3, seed=2, node_rows=80).fit(df, "churn", "id")
    assert any(model.refined)
    got = scores(model, df)
    assert np.mean([(got[i] > 0.5) == y[i] for i in range(1500)]) > 0.85


def test_accuracy_and_importance(spark):
    train, test = frame(spark, 1500, 7), frame(spark, 600, 8)
    truth = {r.id: r.churn for r in test.collect()}
    for node_rows in (10_000, 300):
        model = D.DeepForest(trees=20, seed=3, node_rows=node_rows).fit(train, "churn", "id")
        got = scores(model, test)
        assert np.mean([(got[i] > 0.5) == truth[i] for i in truth]) > 0.75
        weight = model.importance()
        assert abs(sum(weight) - 1) < 1e-9 and weight[4] == 0 and weight[1] == max(weight)


def test_save_and_load(spark, tmp_path):
    df = frame(spark, 300, 9)
    for name, node_rows in (("flat", 1000), ("top", 60)):
        model = D.DeepForest(trees=4, seed=3, node_rows=node_rows).fit(df, "churn", "id")
        model.save(str(tmp_path / name))
        again = D.DeepForestModel.load(spark, str(tmp_path / name))
        assert scores(model, df) == scores(again, df)


def test_limits_with_a_top(spark):
    df = frame(spark, 600, 1)
    model = D.DeepForest(trees=3, seed=1, max_depth=2, node_rows=100).fit(df, "churn", "id")
    assert model.nodes().where("feature >= 0").count() == 0 and len(set(scores(model, df).values())) <= 4 ** 3


def test_one_class_and_empty(spark):
    df = frame(spark, 50).withColumn("churn", F.lit(1))
    assert set(scores(D.DeepForest(trees=2).fit(df, "churn", "id"), df).values()) == {1.0}
    empty = df.limit(0)
    assert scores(D.DeepForest(trees=2).fit(empty, "churn", "id"), empty) == {}
