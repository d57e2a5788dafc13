"""Churn model with Spark MLlib.

Pipeline: ordinal encoding of the plan columns (unknown -> its own index),
numeric features assembled and standardised, both assembled into one vector,
random forest.  The pipeline's forest has no depth limit and grows in
:mod:`.deep_forest`; the random search scores each draw (MLlib forests of a
drawn depth) by cross-validated recall of the churn class.
"""

from __future__ import annotations

import math
import os
import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..sources.files import shared_table
from .aggregates import attach_scalars
from .deep_forest import DeepForest, DeepForestModel
from .features import apply_ordinal, fit_ordinal

LABEL = config.TARGET_COLUMN
WEIGHT = "class_weight"


# ------------------------------------------------------------------ M4, M12
def build_estimator(kind: str = "random_forest", rows: int | None = None, **params):
    """The classifier.

    ``random_forest`` is the pipeline's forest (no depth limit) and
    ``declared_forest`` the one of the model configuration, both
    :class:`DeepForest`; ``search_forest`` is MLlib's forest, whose depth the
    random search draws; ``boosted_trees`` and ``logistic_regression`` have
    their declared settings; ``params`` override them.  ``rows``: the number
    of training rows, needed by the logistic regression (see below)."""
    if kind == "random_forest":
        return DeepForest(**{"trees": config.FOREST_TREES, "seed": config.FOREST_SEED, **params})
    if kind == "declared_forest":
        f = config.FOREST_PARAMS
        args = dict(trees=f["n_estimators"], max_depth=f["max_depth"], min_split=f["min_samples_split"],
                    min_leaf=f["min_samples_leaf"], seed=config.FOREST_SEED)
        return DeepForest(**{**args, **params})
    if kind == "search_forest":
        args = dict(numTrees=config.FOREST_TREES, seed=config.FOREST_SEED, maxDepth=config.SEARCH_DEPTH[1] - 1)
        args.update(params)
        return RandomForestClassifier(labelCol=LABEL, featuresCol="features", **args)
    if kind == "boosted_trees":
        b = config.BOOSTED_PARAMS
        args = dict(maxIter=b["n_estimators"], maxDepth=b["max_depth"], stepSize=b["learning_rate"],
                    seed=config.FOREST_SEED)
        args.update(params)
        return GBTClassifier(labelCol=LABEL, featuresCol="features", **args)
    if kind == "logistic_regression":
        lr = config.LOGREG_PARAMS
        if not rows and "regParam" not in params:
            raise ValueError("logistic regression: give the number of training rows (or regParam)")
        # C weighs the summed loss against |w|^2 / 2; MLlib averages the loss over
        # the rows, so the equal strength is 1 / (C * rows).  The features are
        # scaled already; MLlib's own scaling would change the penalty.
        args = dict(regParam=1.0 / (lr["C"] * (rows or 1)), maxIter=lr["max_iter"], elasticNetParam=0.0,
                    standardization=False, tol=1e-8)
        args.update(params)
        return LogisticRegression(labelCol=LABEL, featuresCol="features", **args)
    raise ValueError(f"unknown estimator {kind!r}")


def preparation(numeric: list[str] | None = None, categorical: list[str] | None = None, encoder: bool = True) -> list:
    """M4: encoder, scaler and assemblers; columns not listed (``gender``,
    the id) never enter the feature vector (P11).  Without ``encoder`` the
    code columns are there already (:class:`Preparation`)."""
    numeric = numeric or config.NUMERICAL_FEATURES
    categorical = categorical or config.ORDINAL_FEATURES
    codes = [f"{c}__code" for c in categorical]
    first = [StringIndexer(inputCols=categorical, outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep")]
    return (first if encoder else []) + [
        VectorAssembler(inputCols=numeric, outputCol="numeric_vec", handleInvalid="keep"),
        StandardScaler(inputCol="numeric_vec", outputCol="numeric_scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=codes + ["numeric_scaled"], outputCol="features"),
    ]


def build_pipeline(estimator=None, numeric: list[str] | None = None,
                   categorical: list[str] | None = None) -> Pipeline:
    """M4: preparation and an MLlib classifier (default: the forest of the random search), unfitted."""
    return Pipeline(stages=[*preparation(numeric, categorical),
                            estimator if estimator is not None else build_estimator("search_forest")])


class Preparation:
    """The fitted preparation with a category dictionary in place of MLlib's encoder.

    The dictionary is a table (:mod:`.categories`): nothing of it is collected
    but the number of categories per column, the code of unseen values (as
    MLlib's encoder gives them).
    """

    def __init__(self, dictionary: DataFrame, scaled: PipelineModel, categorical: list[str]) -> None:
        self.dictionary, self.scaled, self.categorical = dictionary, scaled, categorical
        found = dictionary.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per column
        self.sizes = {c: 0 for c in categorical} | {r.column_name: r.n for r in found}

    @classmethod
    def fit(cls, train: DataFrame, numeric: list[str] | None = None, categorical: list[str] | None = None) -> Preparation:
        categorical = categorical or config.ORDINAL_FEATURES
        own = cls(fit_ordinal(train, categorical), None, categorical)
        own.scaled = Pipeline(stages=preparation(numeric, categorical, encoder=False)).fit(own.coded(train))
        return own

    def coded(self, df: DataFrame) -> DataFrame:
        out = apply_ordinal(df, self.dictionary, self.categorical)
        code = {c: F.when(F.col(f"{c}_code") < 0, self.sizes[c]).otherwise(F.col(f"{c}_code")) for c in self.categorical}
        return out.withColumns({f"{c}__code": v.cast("double") for c, v in code.items()}).drop(*[f"{c}_code" for c in self.categorical])

    def transform(self, df: DataFrame) -> DataFrame:
        return self.scaled.transform(self.coded(df))

    def feature_names(self) -> list[str]:
        return self.categorical + list(self.scaled.stages[0].getInputCols())

    def save(self, path: str) -> None:
        self.dictionary.write.mode("overwrite").parquet(os.path.join(path, "dictionary"))
        self.scaled.write().overwrite().save(os.path.join(path, "scaled"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preparation:
        scaled = PipelineModel.load(os.path.join(path, "scaled"))
        columns = [c.removesuffix("__code") for c in scaled.stages[-1].getInputCols()[:-1]]
        return cls(spark.read.parquet(os.path.join(path, "dictionary")), scaled, columns)


class ForestPipelineModel:
    """The fitted preparation with a fitted :class:`DeepForestModel`."""

    def __init__(self, prepared: Preparation, forest: DeepForestModel) -> None:
        self.prepared, self.forest = prepared, forest
        self.stages = [prepared, forest]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with churn_probability and prediction (p > 0.5)."""
        ready = self.prepared.transform(df).select(*df.columns, "features")
        scored = self.forest.score(ready)
        return scored.withColumn("prediction", (F.col("churn_probability") > 0.5).cast("double"))

    def save(self, path: str) -> None:
        self.prepared.save(os.path.join(path, "prepared"))
        self.forest.save(os.path.join(path, "forest"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestPipelineModel:
        return cls(Preparation.load(spark, os.path.join(path, "prepared")), DeepForestModel.load(spark, os.path.join(path, "forest")))


def feature_names(model) -> list[str]:
    """Names of a fitted pipeline's feature vector slots, in order."""
    if isinstance(model, ForestPipelineModel):
        return model.prepared.feature_names()
    indexer, numeric = model.stages[0], model.stages[1]
    return list(indexer.getInputCols()) + list(numeric.getInputCols())


def add_class_weights(df: DataFrame, balanced: bool = True) -> DataFrame:
    """Weight column for class balancing: n / (2 * n_class) per row, or 1.

    The class counts are a two-row aggregate joined back by broadcast.
    """
    if not balanced:
        return df.withColumn(WEIGHT, F.lit(1.0))
    counts = df.groupBy(LABEL).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("__total"), F.count(F.lit(1)).alias("__k"))
    w = attach_scalars(counts, total).select(
        LABEL, (F.col("__total") / (F.col("__k") * F.col("__n"))).alias(WEIGHT))
    return df.join(F.broadcast(w), LABEL, "left")


def weighted(df: DataFrame) -> DataFrame:
    """Both class weights that the random search chooses from."""
    return add_class_weights(df, True).withColumnRenamed(WEIGHT, "w_balanced").withColumn("w_uniform", F.lit(1.0))


# ------------------------------------------------------------------ M6
def search_space(draws: int = config.SEARCH_DRAWS, seed: int = config.SEARCH_SEED) -> list[dict]:
    """M6: ``draws`` random parameter sets (drawn on the driver, tiny)."""
    rng = random.Random(seed)
    lo, hi = config.SEARCH_SAMPLE_SHARE
    out = []
    for _ in range(draws):
        out.append({
            "numTrees": rng.randrange(*config.SEARCH_TREES),
            "maxDepth": rng.randrange(*config.SEARCH_DEPTH),
            "featureSubsetStrategy": rng.choice(config.SEARCH_FEATURES),
            "balanced": rng.choice(config.SEARCH_CLASS_WEIGHT) == "balanced",
            "subsamplingRate": float(math.exp(rng.uniform(math.log(lo), math.log(hi)))),
        })
    return out


def random_search(train: DataFrame, draws: int = config.SEARCH_DRAWS,
                  folds: int = config.SEARCH_FOLDS, seed: int = config.SEARCH_SEED,
                  parallelism: int = 2, space: list[dict] | None = None):
    """M6: cross-validated random search scored by recall of class 1.

    Returns (best PipelineModel refit on all of ``train``, list of
    (params, mean recall), the unfitted pipeline with the best parameters).
    Class weighting is a choice between a uniform
    and a balanced weight column.  Folds are ``pmod(xxhash64(seed, key),
    folds)`` when the key column is present (as the train/test split), so
    they do not depend on partitioning and a recomputed partition after an
    executor loss lands in the same fold.
    """
    space = space or search_space(draws, seed)
    data = weighted(train)
    key = config.CUSTOMER_ID_COLUMN
    fold_args = {}
    if key in data.columns:
        data = data.withColumn(
            "__fold", F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(folds)).cast("int"))
        fold_args = {"foldCol": "__fold"}
    rf = build_estimator("search_forest", weightCol="w_uniform")
    pipe = build_pipeline(rf)
    maps = []
    for p in space:
        maps.append({rf.numTrees: p["numTrees"], rf.maxDepth: p["maxDepth"],
                     rf.featureSubsetStrategy: p["featureSubsetStrategy"],
                     rf.subsamplingRate: p["subsamplingRate"],
                     rf.weightCol: "w_balanced" if p["balanced"] else "w_uniform"})
    evaluator = MulticlassClassificationEvaluator(
        labelCol=LABEL, predictionCol="prediction", metricName="recallByLabel", metricLabel=1.0)
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=evaluator,
                        numFolds=folds, seed=seed, parallelism=parallelism, **fold_args)
    cv_model: CrossValidatorModel = cv.fit(data)
    scores = list(zip(space, cv_model.avgMetrics))
    best = maps[max(range(len(maps)), key=lambda i: cv_model.avgMetrics[i])]
    return cv_model.bestModel, scores, build_pipeline(rf.copy(best))


def halving_search(train: DataFrame, draws: int = config.SEARCH_DRAWS, folds: int = config.SEARCH_FOLDS,
                   seed: int = config.SEARCH_SEED, space: list[dict] | None = None):
    """M6 by successive halving: as :func:`random_search`, with fewer fits.

    The same draws and folds.  Every fold's features are prepared and
    written once and shared by all draws.  All draws are fitted on the first
    fold; the better half goes on to the second, the better half of these to
    the third, and so on, the last (at least two) to all folds.  The best of
    those by mean recall wins (ties: the first draw).  A draw that is weak on
    the early folds only can be lost, which the full search would not.
    Returns what ``random_search`` returns; the score of a draw that went
    out early is the mean over the folds it has seen.
    """
    space = space or search_space(draws, seed)
    data = weighted(train)
    fold = F.pmod(F.xxhash64(F.lit(seed), F.col(config.CUSTOMER_ID_COLUMN)), F.lit(folds))
    kept = ["features", LABEL, "w_balanced", "w_uniform"]
    sides: dict[int, tuple[DataFrame, DataFrame]] = {}

    def recall(p: dict, f: int) -> float:
        if f not in sides:
            inside, outside = data.where(fold != f), data.where(fold == f)
            ready = Pipeline(stages=preparation()).fit(inside)
            sides[f] = tuple(shared_table(ready.transform(x).select(*kept), "fold") for x in (inside, outside))
        fitted = _search_forest(p).fit(sides[f][0])
        hits = fitted.transform(sides[f][1]).agg(F.count_if((F.col(LABEL) == 1) & (F.col("prediction") == 1)).alias("tp"),
                                                 F.count_if(F.col(LABEL) == 1).alias("p")).first()
        return hits.tp / hits.p if hits.p else 0.0

    seen: list[list[float]] = [[] for _ in space]
    alive = list(range(len(space)))
    for f in range(folds):
        for i in alive:
            seen[i].append(recall(space[i], f))
        if f < folds - 1:
            order = sorted(alive, key=lambda i: (-sum(seen[i]) / len(seen[i]), i))
            alive = sorted(order[:max(2, -(-len(alive) // 2))])
    mean = [sum(s) / len(s) for s in seen]
    best = min(alive, key=lambda i: (-mean[i], i))
    pipeline = build_pipeline(_search_forest(space[best]))
    return pipeline.fit(data), list(zip(space, mean)), pipeline


def _search_forest(p: dict) -> RandomForestClassifier:
    """The forest of one draw."""
    return build_estimator("search_forest", numTrees=p["numTrees"], maxDepth=p["maxDepth"], subsamplingRate=p["subsamplingRate"],
                           featureSubsetStrategy=p["featureSubsetStrategy"], weightCol="w_balanced" if p["balanced"] else "w_uniform")


# ------------------------------------------------------------------ M7, M9-M11, M13, S6
def fit(train: DataFrame, estimator=None):
    """M7: fit the pipeline (default: the forest without a depth limit)."""
    estimator = estimator if estimator is not None else build_estimator()
    if not isinstance(estimator, DeepForest):
        return build_pipeline(estimator).fit(train)
    prepared = Preparation.fit(train)
    return ForestPipelineModel(prepared, estimator.fit(prepared.transform(train), LABEL, config.CUSTOMER_ID_COLUMN))


def feature_importance(model, spark: SparkSession) -> DataFrame:
    """M7: importances of the fitted forest joined to the feature names."""
    forest = model.stages[-1]
    values = forest.importance() if isinstance(forest, DeepForestModel) else forest.featureImportances.toArray().tolist()
    rows = list(zip(feature_names(model), [float(v) for v in values], strict=True))
    schema = T.StructType([T.StructField("feature", T.StringType(), False),
                           T.StructField("importance", T.DoubleType(), False)])
    return spark.createDataFrame(rows, schema)


def risk_band(p) -> F.Column:
    """High from 0.7, medium from 0.4, else low."""
    expr = None
    for lo, name in config.RISK_BANDS:
        expr = F.when(p >= lo, name) if expr is None else expr.when(p >= lo, name)
    return expr


def score(model, df: DataFrame, key: str = config.CUSTOMER_ID_COLUMN) -> DataFrame:
    """M9: churn probability and risk band per customer."""
    scored = model.transform(df)
    if not isinstance(model, ForestPipelineModel):
        scored = scored.withColumn("churn_probability", vector_to_array(F.col("probability"))[1]).drop("probability")
    return banded(scored, key, F.col("prediction").cast("int"))


def banded(df: DataFrame, key: str = config.CUSTOMER_ID_COLUMN, prediction=None) -> DataFrame:
    """M9: key, probability, risk band, prediction (default: p >= 0.5) and the label if there is one."""
    p = F.col("churn_probability")
    if prediction is None:
        prediction = (p >= 0.5).cast("int")
    return df.select(F.col(key), p, risk_band(p).alias("risk_category"), prediction.alias("prediction"),
                     *([F.col(LABEL)] if LABEL in df.columns else []))


def high_risk(scores: DataFrame, threshold: float = config.HIGH_RISK_THRESHOLD,
              k: int = config.HIGH_RISK_TOP, key: str = config.CUSTOMER_ID_COLUMN) -> DataFrame:
    """The ``k`` most likely churners at or above ``threshold``."""
    return (scores.where(F.col("churn_probability") >= threshold)
            .orderBy(F.desc("churn_probability"), F.asc(key)).limit(k))


def confusion(scores: DataFrame) -> DataFrame:
    """Counts per (actual, predicted)."""
    return scores.groupBy(F.col(LABEL).alias("actual"), "prediction").agg(
        F.count(F.lit(1)).alias("count"))


def recall_f1(scores: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """M8: recall, precision and F1 of class 1 in one aggregate.

    -> tp, fp, fn, tn, recall, precision, f1.
    """
    y = F.col(label).cast("int")
    p = F.col(prediction).cast("int")
    agg = scores.agg(F.count_if((y == 1) & (p == 1)).alias("tp"),
                     F.count_if((y == 0) & (p == 1)).alias("fp"),
                     F.count_if((y == 1) & (p == 0)).alias("fn"),
                     F.count_if((y == 0) & (p == 0)).alias("tn"))
    return agg.select("tp", "fp", "fn", "tn",
                      F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                      F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                      F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def save(stage, path: str) -> str:
    """Persist a fitted or an unfitted pipeline (overwrite)."""
    if isinstance(stage, ForestPipelineModel):
        stage.save(path)
    else:
        stage.write().overwrite().save(path)
    return path


def load(path: str):
    """Load a fitted pipeline."""
    spark = SparkSession.active()
    if _exists(spark, os.path.join(path, "forest")):
        return ForestPipelineModel.load(spark, path)
    return PipelineModel.load(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


# What a run leaves in the model folder (shared storage on a cluster)
TUNED, BEST, UNFITTED = "optim_model", "best_estimator", "pipeline"


def save_unfitted(model_dir: str) -> str:
    """The unfitted pipeline, from which a later run can start."""
    return save(build_pipeline(), os.path.join(model_dir, UNFITTED))


def reuse_or_fit(spark: SparkSession, train: DataFrame, model_dir: str, search=random_search, **search_args) -> PipelineModel:
    """The furthest artefact that ``model_dir`` holds decides.

    A fitted model is used as it is.  The search's best estimator is fitted
    again.  An unfitted pipeline goes through the search (``random_search`` or
    ``halving_search``), whose best
    estimator is saved and fitted.  Whatever is fitted is saved as the
    fitted model.  With none of the three this is an error.
    """
    tuned, best, unfitted = (os.path.join(model_dir, n) for n in (TUNED, BEST, UNFITTED))
    if _exists(spark, tuned):
        return load(tuned)
    if _exists(spark, best):
        pipeline = Pipeline.load(best)
    elif _exists(spark, unfitted):
        pipeline = search(train, **search_args)[2]
        save(pipeline, best)
    else:
        raise FileNotFoundError(f"no saved model or pipeline in {model_dir}")
    model = pipeline.fit(weighted(train))
    save(model, tuned)
    return model
