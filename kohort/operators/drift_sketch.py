"""Drift from stored quantile sketches (D2, opt-in).

The exact path (:func:`drift.numeric_drift`) reads both snapshots.  Here a
snapshot leaves one row per column: a KLL sketch, count, sums, smallest and
largest value.  Such rows are stored per snapshot, merged (days to a month,
shards to a whole), and compared without reading any snapshot again.

Bound: a KLL sketch with parameter ``k`` answers a quantile ``p`` with a value
between the exact quantiles ``p - e`` and ``p + e``, ``e = 2.296 / k**0.9021``
(at 99 % confidence; 0.0013 for the largest ``k``).  The mean over the grid
then differs from the exact one by at most ``(2 e + 1 / points)`` times the
value ranges of both sides, because the gaps add up to the range.
``error_bound`` states it per column, divided by the reference deviation
like the score; a drift is ``certain`` when the score lies further than that
from the threshold.

Null and NaN values are ignored; a column without any value on one side has
drifted completely (score infinity), without any on both not at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from .aggregates import unpivot
from .drift import quantile_grid

#: sketch parameter: up to 4,096 values are kept per level
SIZE = 4096


def rank_error(size: int = SIZE) -> float:
    """Largest rank error of a sketch, as a share of the values (99 % confidence)."""
    return 2.296 / size ** 0.9021


def sketch(snapshot: DataFrame, columns: list[str] | None = None, size: int = SIZE) -> DataFrame:
    """column_name, sketch, n, total, squares, lo, hi: one row per column with values."""
    columns = [c for c in (columns or config.MONITORING_COLUMNS) if c in snapshot.columns]
    long = unpivot(snapshot, [], columns).where("value IS NOT NULL AND NOT isnan(value)")
    x = F.col("value")
    return long.groupBy("column_name").agg(
        F.kll_sketch_agg_double("value", size).alias("sketch"), F.count(F.lit(1)).alias("n"), F.sum(x).alias("total"),
        F.sum(x * x).alias("squares"), F.min(x).alias("lo"), F.max(x).alias("hi"))


def merge(*sketches: DataFrame, size: int = SIZE) -> DataFrame:
    """The sketch of all rows that the given ones have seen; merging in any order is the same up to the bound."""
    both = reduce(DataFrame.unionByName, sketches)
    return both.groupBy("column_name").agg(
        F.kll_merge_agg_double("sketch", size).alias("sketch"), F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.sum("squares").alias("squares"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def store(sketches: DataFrame, path: str, snapshot: str) -> None:
    """Keep a snapshot's sketches; a repeated store of the same snapshot replaces them."""
    sketches.withColumn("snapshot", F.lit(snapshot)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("snapshot").parquet(path)


def stored(spark: SparkSession, path: str, snapshots: list[str]) -> DataFrame:
    """The merged sketches of the named snapshots."""
    found = spark.read.option("basePath", path).parquet(*[f"{path}/snapshot={s}" for s in snapshots])
    return merge(found.drop("snapshot"))


def sketch_drift(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
                 threshold: float = config.DRIFT_THRESHOLD, points: int = config.QUANTILE_GRID, size: int = SIZE,
                 digits: int = 6) -> DataFrame:
    """column_name, stat_test, drift_score, drift_detected, error_bound, certain: one row per column."""
    columns = columns or config.MONITORING_COLUMNS
    grid = F.array(*[F.lit(p) for p in quantile_grid(points)])

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("column_name", F.kll_sketch_get_quantile_double("sketch", grid).alias(f"{name}q"),
                         (F.col("hi") - F.col("lo")).alias(f"{name}range"), "n", "total", "squares")

    every = reference.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("column_name"))
    ref = side(reference, "r")
    variance = F.col("squares") / F.col("n") - (F.col("total") / F.col("n")) ** 2
    # a constant column: rounding must not leave a deviation
    std = F.when(F.col("rrange") == 0, 0.0).otherwise(F.sqrt(F.greatest(variance, F.lit(0.0))))
    both = (every.join(ref.withColumn("std", std).drop("n", "total", "squares"), "column_name", "left")
            .join(side(current, "c").drop("n", "total", "squares"), "column_name", "left"))
    gaps = F.zip_with("rq", "cq", lambda a, b: F.abs(a - b))
    w1 = F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g) / F.size(gaps)
    infinite = F.lit(float("inf"))
    score = (F.when(F.col("rq").isNull() & F.col("cq").isNull(), 0.0)
             .when(F.col("rq").isNull() | F.col("cq").isNull(), infinite)
             .when(F.col("std") == 0, F.when(w1 == 0, 0.0).otherwise(infinite))
             .otherwise(w1 / F.col("std")))
    bound = (2 * rank_error(size) + 1 / points) * (F.col("rrange") + F.col("crange"))
    bound = F.coalesce(F.try_divide(bound, F.col("std")), F.lit(0.0))
    score = F.when(score == infinite, score).otherwise(F.round(score, digits))
    out = both.select("column_name", F.lit("wasserstein_norm").alias("stat_test"), score.alias("drift_score"),
                      bound.alias("error_bound"))
    return out.select("column_name", "stat_test", "drift_score", (F.col("drift_score") >= threshold).alias("drift_detected"),
                      "error_bound", (F.abs(F.col("drift_score") - threshold) > F.col("error_bound")).alias("certain"))
