"""Generic aggregation operators: value counts, period counts, pivots,
describe, cross-tabulation, histogram, box-plot statistics, correlation.

Every operator is one (or a few) grouped aggregates with map-side partial
aggregation; statistics over many columns are computed in a single ``agg``
and unpivoted with ``stack``, never with a job per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_start


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row frame to every row of ``df``.

    ``one_row`` (a global aggregate: one row by construction) becomes an
    uncorrelated scalar subquery: it runs once, its single struct value is
    inlined as a constant in the projection, so ``df`` is neither shuffled
    nor joined.  The struct is selected in one projection and unpacked in
    the next, so the subquery is evaluated once whatever the number of
    fields.  An empty one-row side gives nulls.
    """
    packed = one_row.select(F.struct(*[F.col(_q(c)) for c in one_row.columns]).alias("__s"))
    return (df.select("*", packed.scalar().alias("__s"))
            .select(*[F.col(_q(c)) for c in df.columns],
                    *[F.col("__s")[c].alias(c) for c in one_row.columns]))


def unpivot(df: DataFrame, ids: list[str], columns: list[str],
            name: str = "column_name", value: str = "value", cast: str = "double") -> DataFrame:
    """Wide -> long with ``stack`` (one pass, no union of per-column jobs)."""
    pairs = ", ".join(f"'{c}', CAST({_q(c)} AS {cast})" for c in columns)
    return df.select(*ids, F.expr(f"stack({len(columns)}, {pairs}) AS ({name}, {value})"))


# ------------------------------------------------------------------ A2, P10
def value_counts(df: DataFrame, column: str, name: str = "value") -> DataFrame:
    """A2: frequency per non-null value with its share of the counted rows,
    most frequent first (ties by value).

    -> value, count, share_pct.  The total is a one-row aggregate of the
    counts, inlined as a scalar (no single-task window).
    """
    counts = (df.where(F.col(column).isNotNull())
              .groupBy(F.col(column).alias(name))
              .agg(F.count(F.lit(1)).alias("count")))
    total = counts.agg(F.sum("count").alias("__total"))
    return (attach_scalars(counts, total)
            .withColumn("share_pct", F.col("count") * 100 / F.col("__total"))
            .drop("__total")
            .orderBy(F.desc("count"), F.asc(name)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """P10: distinct values of a column (null excluded)."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


# ------------------------------------------------------------------ A3, A4, A17
def count_by_month(df: DataFrame, date_col: str, name: str = "count",
                   by: str | None = None) -> DataFrame:
    """Rows per calendar month of ``date_col`` (null dates excluded)."""
    keys = [month_start(date_col).alias("month")] + ([F.col(by)] if by else [])
    return (df.where(F.col(date_col).isNotNull())
            .groupBy(*keys).agg(F.count(F.lit(1)).alias(name)))


def pivot_counts(df: DataFrame, row_key: Column | str, pivot_col: str,
                 values: list | None = None, fill: int | None = None) -> DataFrame:
    """Two-key counts with the second key as columns.

    Missing combinations stay null (``fill`` replaces them).  Without
    ``values`` every value in the data becomes a column: Spark collects the
    distinct values first and fails when there are more than
    ``spark.sql.pivotMaxValues``.
    """
    out = (df.where(F.col(pivot_col).isNotNull())
           .groupBy(row_key).pivot(pivot_col, values).count())
    return out.fillna(fill) if fill is not None else out


# ------------------------------------------------------------------ A9, A10
STAT_NAMES = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]


def describe(df: DataFrame, columns: list[str], by: str | None = None,
             digits: int = 4) -> DataFrame:
    """Count, mean, std (sample), min, exact quartiles, max.

    The long form (group = column [and ``by``]) is written once; moments
    are one aggregate over it, quartiles come from
    :mod:`kohort.operators.quantiles`.  Result: one row per (group, column).
    """
    from ..sources.files import shared_table
    from .quantiles import quantile_array

    ids = [by] if by else []
    long = shared_table(unpivot(df, ids, columns).where(F.col("value").isNotNull()), "long")
    moments = long.groupBy(*ids, "column_name").agg(
        F.count("value").alias("count"),
        F.round(F.avg("value"), digits).alias("mean"),
        F.round(F.stddev_samp("value"), digits).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quart = quantile_array(long, "value", [0.25, 0.5, 0.75], ids + ["column_name"], name="q", written=True) \
        .withColumnsRenamed({k: f"__{k}" for k in ids + ["column_name"]})
    same = [moments[k].eqNullSafe(quart[f"__{k}"]) for k in ids + ["column_name"]]
    out = moments.join(quart, same, "left")
    return out.select(*ids, "column_name", "count", "mean", "std", "min",
                      *[F.round(F.col("q")[i], digits).alias(n) for i, n in enumerate(["p25", "p50", "p75"])],
                      "max")


# ------------------------------------------------------------------ A11
def crosstab(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Zero-filled counts of ``row`` x ``col`` with fixed column values.

    Columns are named ``<col>_<value>`` in lower case.
    """
    out = pivot_counts(df, row, col, values, fill=0)
    return out.toDF(row, *[f"{col}_{str(v).lower()}" for v in values])


# ------------------------------------------------------------------ A23
def correlation_matrix(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every ordered column pair (pairwise
    complete rows), long form -> col_a, col_b, corr.

    All pairs come from one pass of blocked matrix products (:mod:`.gram`),
    whatever their number; a column that is constant over a pair's rows gives
    null instead of an error.
    """
    from .gram import correlations

    if len(columns) < 2:
        raise ValueError("need at least two columns for a correlation matrix")
    return correlations(df, columns, digits)


# ------------------------------------------------------------------ A24
def histogram(df: DataFrame, columns: list[str], bins: int, by: str | None = None,
              digits: int = 6) -> DataFrame:
    """Equal-width bin counts over each column's min..max.

    Bins are shared across the ``by`` groups (one range per column), and
    every column [and group] has all of them, empty ones with count 0.  The
    maximum falls in the last bin; a constant column puts everything in
    bin 1.  -> column_name, [by,] bin, bin_start, count.
    """
    from ..sources.files import shared_table

    ids = [by] if by else []
    long = shared_table(unpivot(df, ids, columns).where(F.col("value").isNotNull()), "long")
    ranges = long.groupBy("column_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    # one row per column: broadcast, bounded by the number of columns
    joined = long.join(F.broadcast(ranges), "column_name")
    width = F.col("hi") - F.col("lo")
    raw = F.floor((F.col("value") - F.col("lo")) / width * bins) + 1
    bin_ = F.when(width == 0, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")
    counted = (joined.groupBy(F.col("column_name").alias("__c"), *[F.col(_q(k)).alias("__by") for k in ids], bin_.alias("__bin"))
               .agg(F.count(F.lit(1)).alias("__n")))
    grid = ranges
    if by:  # the groups are classes: their list is one small value
        groups = long.agg(F.collect_set(F.struct(F.col(_q(by)).alias("g"))).alias("__groups"))
        grid = attach_scalars(grid, groups).select("column_name", "lo", "hi", F.explode("__groups").alias("__g")) \
            .select("column_name", "lo", "hi", F.col("__g.g").alias(by))
    grid = grid.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    same = (F.col("column_name") == F.col("__c")) & (F.col("bin") == F.col("__bin"))
    if by:
        same = same & F.col(_q(by)).eqNullSafe(F.col("__by"))
    start = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") - 1) / bins
    return grid.join(counted, same, "left").select(
        "column_name", *ids, "bin", F.round(start, digits).alias("bin_start"), F.coalesce("__n", F.lit(0)).alias("count"))


# ------------------------------------------------------------------ A25
def boxplot_stats(df: DataFrame, column: str, whisker: float = 1.5,
                  digits: int = 6) -> DataFrame:
    """Quartiles, whiskers (most extreme values within ``whisker`` x
    IQR of the quartiles) and the number of points outside them."""
    from ..sources.files import shared_table
    from .quantiles import quantile_array

    x = shared_table(df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull()), "values")
    quart = quantile_array(x, "x", [0.25, 0.5, 0.75], name="q", written=True).select(
        F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    quart = quart.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - whisker * F.col("iqr")
    hi = F.col("q3") + whisker * F.col("iqr")
    stats = attach_scalars(x, quart).groupBy("q1", "median", "q3", "iqr").agg(
        F.min(F.when(F.col("x") >= lo, F.col("x"))).alias("lower_whisker"),
        F.max(F.when(F.col("x") <= hi, F.col("x"))).alias("upper_whisker"),
        F.count_if((F.col("x") < lo) | (F.col("x") > hi)).alias("outliers"),
    )
    return stats.select(*[F.round(c, digits).alias(c) for c in
                          ["q1", "median", "q3", "iqr", "lower_whisker", "upper_whisker"]],
                        "outliers")
