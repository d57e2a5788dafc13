"""Drift monitoring between a reference and a current snapshot.

Statistics (fixed here; larger = more drift):

* numeric columns: Wasserstein-1 distance divided by the reference
  population deviation, computed as the mean absolute gap between the two
  quantile functions on a grid of ``QUANTILE_GRID`` mid-points;
* numeric columns, also: Kolmogorov-Smirnov statistic and population
  stability index over bins cut at the reference deciles;
* categorical columns and the target: Jensen-Shannon distance (base 2).

Each side is reduced by one aggregate (quantile arrays, or per-bin and
per-category counts) before the two sides meet, so only a handful of rows
per column are ever joined.  No window runs over raw values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..sources.files import shared_table
from .aggregates import attach_scalars, unpivot
from .cleaning import clean
from .quantiles import quantile_array


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quantile_grid(points: int = config.QUANTILE_GRID) -> list[float]:
    """Mid-points (i + 0.5) / points, i = 0..points-1."""
    return [(i + 0.5) / points for i in range(points)]


# ------------------------------------------------------------------ D1
def snapshot(customers: DataFrame, columns: list[str] | None = None,
             target: str | None = config.TARGET_COLUMN) -> DataFrame:
    """Cleaned snapshot restricted to the monitored columns (+ target).

    Duplicates are dropped over the full rows; only the wanted columns are
    written and cleaned."""
    cols = list(columns or config.MONITORING_COLUMNS)
    keep = cols + ([target] if target and target in customers.columns else [])
    return clean(customers, keep=keep)


# ------------------------------------------------------------------ D2
def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    return unpivot(df, [], columns).where(F.col("value").isNotNull())


def _monitored(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per monitored column, also for those without any value."""
    return df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")


def numeric_drift(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
                  threshold: float = config.DRIFT_THRESHOLD, points: int = config.QUANTILE_GRID,
                  digits: int = 6) -> DataFrame:
    """Normalised Wasserstein distance per numeric column.

    Both sides go to long form (side, column_name, value), written once; one
    exact-quantile pass over both yields a ``points``-element quantile array
    per side and column, and only those arrays meet.  A column without any value on
    one side has drifted completely (score infinity), without any on both
    not at all.  -> column_name, stat_test, drift_score, drift_detected.
    """
    columns = [c for c in (columns or config.MONITORING_COLUMNS)
               if c in reference.columns and c in current.columns]
    grid = quantile_grid(points)
    sides = [_long(df, columns).select(F.lit(side).alias("side"), "column_name", "value")
             for side, df in (("reference", reference), ("current", current))]
    long = shared_table(sides[0].unionByName(sides[1]), "long")
    # one row per side and column
    quantiles = shared_table(quantile_array(long, "value", grid, ["side", "column_name"], name="q", written=True), "grids")
    ref_q, cur_q = (quantiles.where(F.col("side") == side).select("column_name", F.col("q").alias(name))
                    for side, name in (("reference", "rq"), ("current", "cq")))
    ref_std = long.where("side = 'reference'").groupBy("column_name").agg(F.stddev_pop("value").alias("std"))
    # one row per column on each side
    both = _monitored(reference, columns)
    for side in (ref_q, cur_q, ref_std):
        both = both.join(side, "column_name", "left")
    gaps = F.zip_with("rq", "cq", lambda a, b: F.abs(a - b))
    w1 = F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g) / F.size(gaps)
    std, infinite = F.col("std"), F.lit(float("inf"))
    score = (F.when(F.col("rq").isNull() & F.col("cq").isNull(), 0.0)
             .when(F.col("rq").isNull() | F.col("cq").isNull(), infinite)
             # a constant reference: any shift is total drift, none is none
             .when(std == 0, F.when(w1 == 0, 0.0).otherwise(infinite))
             .otherwise(F.try_divide(w1, std)))
    score = F.when(score == infinite, score).otherwise(F.round(score, digits))
    return both.select("column_name", F.lit("wasserstein_norm").alias("stat_test"), score.alias("drift_score")) \
        .withColumn("drift_detected", F.col("drift_score") >= threshold)


def binned_drift(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
                 bins: int = 10, eps: float = 1e-4, digits: int = 6) -> DataFrame:
    """D2 (also reported): KS statistic and PSI over reference-quantile bins.

    Bin edges are the reference quantiles at 1/bins .. (bins-1)/bins; a value
    falls in bin ``#edges < value`` (without a reference value, in bin 0).
    Shares below ``eps`` are clipped for PSI; a side without any value has
    share 0 in every bin.  The running sums run over the binned table (bins
    rows per column).  -> column_name, ks, psi.
    """
    columns = [c for c in (columns or config.MONITORING_COLUMNS)
               if c in reference.columns and c in current.columns]
    ref_long, cur_long = (shared_table(_long(side, columns), "long") for side in (reference, current))
    edges = quantile_array(ref_long, "value", [i / bins for i in range(1, bins)], ["column_name"],
                           name="edges", written=True)
    edges = shared_table(_monitored(reference, columns).join(edges, "column_name", "left"), "edges")

    def counts(long: DataFrame, side: str) -> DataFrame:
        # one row per column: broadcast
        j = long.join(F.broadcast(edges), "column_name")
        b = F.size(F.filter(F.coalesce("edges", F.array().cast("array<double>")), lambda e: e < F.col("value")))
        return j.groupBy("column_name", b.alias("bin")).agg(F.count(F.lit(1)).alias(side))

    ref_c, cur_c = counts(ref_long, "r"), counts(cur_long, "c")
    grid = edges.select("column_name", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    table = (grid.join(ref_c, ["column_name", "bin"], "left")
             .join(cur_c, ["column_name", "bin"], "left").fillna(0, ["r", "c"]))
    w_all = Window.partitionBy("column_name")
    w_cum = w_all.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def share(side: str):
        return F.coalesce(F.try_divide(F.col(side), F.sum(side).over(w_all)), F.lit(0.0))

    table = (table
             .withColumn("pr", share("r"))
             .withColumn("pc", share("c"))
             .withColumn("gap", F.abs(F.sum("pr").over(w_cum) - F.sum("pc").over(w_cum)))
             .withColumn("pr_", F.greatest("pr", F.lit(eps)))
             .withColumn("pc_", F.greatest("pc", F.lit(eps)))
             .withColumn("psi_t", (F.col("pc_") - F.col("pr_")) * F.log(F.col("pc_") / F.col("pr_"))))
    return table.groupBy("column_name").agg(F.round(F.max("gap"), digits).alias("ks"),
                                            F.round(F.sum("psi_t"), digits).alias("psi"))


# ------------------------------------------------------------------ D3
def categorical_drift(reference: DataFrame, current: DataFrame, columns: list[str],
                      threshold: float = config.DRIFT_THRESHOLD, digits: int = 6) -> DataFrame:
    """D3: Jensen-Shannon distance (base 2) of each categorical column's
    distribution.  -> column_name, stat_test, drift_score, drift_detected."""
    def shares(df: DataFrame, side: str) -> DataFrame:
        long = unpivot(df, [], columns, cast="STRING").where(F.col("value").isNotNull())
        counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        totals = counts.groupBy("column_name").agg(F.sum("n").alias("t"))
        return counts.join(F.broadcast(totals), "column_name").select(
            "column_name", "value", (F.col("n") / F.col("t")).alias(side))

    p = shares(reference, "p")
    q = shares(current, "q")
    both = p.join(q, ["column_name", "value"], "full").fillna(0.0, ["p", "q"])
    m = (F.col("p") + F.col("q")) / 2

    def kl(a):
        return F.when(F.col(a) > 0, F.col(a) * F.log2(F.col(a) / m)).otherwise(0.0)

    js = both.groupBy("column_name").agg((0.5 * F.sum(kl("p")) + 0.5 * F.sum(kl("q"))).alias("js"))
    score = F.round(F.sqrt(F.greatest(F.col("js"), F.lit(0.0))), digits)
    return js.select("column_name", F.lit("jensenshannon").alias("stat_test"),
                     score.alias("drift_score"), (score >= threshold).alias("drift_detected"))


def target_drift(reference: DataFrame, current: DataFrame, target: str = config.TARGET_COLUMN,
                 threshold: float = config.DRIFT_THRESHOLD) -> DataFrame:
    """D3: drift of the label distribution."""
    return categorical_drift(reference, current, [target], threshold)


# ------------------------------------------------------------------ D4-D6
def drift_report(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
                 target: str = config.TARGET_COLUMN,
                 threshold: float = config.DRIFT_THRESHOLD) -> DataFrame:
    """Monitored columns and the target in one table."""
    out = numeric_drift(reference, current, columns, threshold)
    if target in reference.columns and target in current.columns:
        out = out.unionByName(target_drift(reference, current, target, threshold))
    return out


def drift_alerts(report: DataFrame, threshold: float = config.DRIFT_THRESHOLD) -> DataFrame:
    """Alert when drift is detected and the score exceeds ``threshold``."""
    return report.withColumn("alert", F.col("drift_detected") & (F.col("drift_score") > threshold))


def dataset_counters(report: DataFrame, current: DataFrame) -> DataFrame:
    """Drifted columns, rows, columns and missing cells of the current
    snapshot -> one row."""
    cols = current.columns
    missing = sum((F.count_if(F.col(_q(c)).isNull()) for c in cols), F.lit(0))
    cur = current.agg(F.count(F.lit(1)).alias("rows"), missing.alias("missing_values"))
    drifted = report.agg(F.count_if(F.col("drift_detected")).alias("drifted_columns"),
                         F.count(F.lit(1)).alias("monitored_columns"))
    return attach_scalars(drifted, cur).select(
        "drifted_columns", "monitored_columns", "rows",
        F.lit(len(cols)).cast("bigint").alias("columns"), "missing_values")
