"""Exact quantiles of groups of any size in a fixed number of jobs.

A quantile interpolates between the values of two ranks (``floor`` and
``ceil`` of ``p * (n - 1)``), as Spark's ``percentile`` does.

1. The values are written once to the shared folder (two or three narrow
   columns).
2. One aggregate per group: count, smallest and largest value, and a
   quantile summary (``percentile_approx``) whose rank error is at most
   ``n / ACCURACY``.  It gives every wanted rank a bracket of values three
   times as wide, so that the rank surely lies in it.  Groups of at most
   ``ACCURACY`` values are one bracket.
3. One pass counts the values between the brackets' ends, and every single
   value inside a bracket.  A value finds its place among the sorted ends by
   a binary search in generated code.
4. Running sums over the counts (a few per bracket end and group, then the
   values of one bracket) give the ranks' values, exactly.

The number of jobs does not depend on the data.  A map task sends at most
``ACCURACY`` entries of a summary per group, then one row per bracket end and
per different value inside the brackets: about ``6 / ACCURACY`` of the values
per wanted rank.  Running sums stream over sorted rows, so no task holds
a bracket.  These jobs run while the query is being built.

Null and NaN values are ignored; a group without any other value has no
result; null group keys form a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import shared_table
from .aggregates import attach_scalars

#: a summary's rank error is at most 1 / ACCURACY of a group's values
ACCURACY = 10_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of the group keys."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"__r_{k}"])
    return cond


def _locate(df: DataFrame, size: int) -> DataFrame:
    """``__place``: how many of the sorted ``__ends`` (at most ``size``) are not above ``__v``."""
    step = 1 << size.bit_length() - 1
    df = df.withColumn("__place", F.lit(0))
    while step:  # binary search: a projection per step
        reached = F.get("__ends", F.col("__place") + (step - 1)) <= F.col("__v")
        df = df.withColumn("__place", F.col("__place") + F.when(reached, step).otherwise(0))
        step //= 2
    return df


def _renamed(df: DataFrame, by: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"__r_{k}" for k in by})


def _attached(df: DataFrame, small: DataFrame, by: list[str]) -> DataFrame:
    """``df`` with the columns of its group's row in ``small``."""
    if not by:
        return attach_scalars(df, small)
    side = _renamed(small, by)
    return df.join(side, _same(df, side, by)).drop(*[f"__r_{k}" for k in by])


def _groups(values: DataFrame, by: list[str], probs: list[float]) -> DataFrame:
    """by..., __n, __ends (sorted bracket ends), __open (whether the gap after each end lies in a bracket)."""
    margin = 3 / ACCURACY
    sides = F.array(*[F.lit(min(1.0, max(0.0, p + d))) for p in probs for d in (-margin, margin)])
    found = values.groupBy(*by).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"),
        F.percentile_approx("__v", sides, F.lit(ACCURACY)).alias("__sides")).where("__n > 0")
    whole = F.array("__lo", "__hi")
    sides = F.when(F.col("__n") <= ACCURACY, whole).otherwise(F.col("__sides"))
    found = found.withColumn("__sides", sides).withColumn("__ends", F.array_sort(F.array_distinct(F.concat(whole, "__sides"))))
    # the two ends of a bracket stand side by side
    starts = F.expr("filter(__sides, (x, i) -> i % 2 = 0)")
    stops = F.expr("filter(__sides, (x, i) -> i % 2 = 1)")
    found = found.withColumn("__brackets", F.arrays_zip(starts.alias("a"), stops.alias("b")))
    gaps = F.transform("__ends", lambda e, i: F.exists(
        "__brackets", lambda x: (x["a"] <= e) & (F.get("__ends", i + 1) <= x["b"])))
    return found.select(*by, "__n", "__ends", gaps.alias("__open"))


def _counted(values: DataFrame, groups: DataFrame, by: list[str], probs: list[float]) -> DataFrame:
    """by..., __bucket, __value, __count.

    Buckets alternate: gap before an end (even), the end itself (odd).  A gap
    in a bracket has one row for each of its values, any other bucket one row.
    """
    met = _locate(_attached(values, groups.select(*by, "__ends", "__open"), by), 2 * len(probs) + 2)
    last = F.col("__place") - 1
    on_end = F.get("__ends", last) == F.col("__v")
    met = met.withColumn("__bucket", 2 * F.col("__place") - F.when(on_end, 1).otherwise(0))
    listed = ~on_end & F.get("__open", last)
    return (met.groupBy(*by, "__bucket", F.when(listed, F.col("__v")).alias("__listed"))
            .agg(F.count(F.lit(1)).alias("__count"), F.min("__v").alias("__value")).drop("__listed"))


def _rank_values(counted: DataFrame, groups: DataFrame, by: list[str], probs: list[float]) -> DataFrame:
    """by..., __rank, __value for every rank that the quantiles need."""
    sizes = counted.groupBy(*by, "__bucket").agg(F.sum("__count").alias("__size"))
    # a few rows per bracket end of a group
    before = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__size").over(before), F.lit(0)))
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(x), F.ceil(x)) for x in (_place(F.lit(p)) for p in probs)])))
    asked = _attached(sizes, groups.select(*by, ranks.alias("__ranks")), by)
    here = F.filter("__ranks", lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__size")))
    asked = asked.select(*by, "__bucket", "__before", here.alias("__here")).where(F.size("__here") > 0)
    side = _renamed(asked, by).withColumnRenamed("__bucket", "__b")
    rows = counted.join(side, _same(counted, side, by) & (F.col("__bucket") == F.col("__b")))
    rows = rows.select(*[counted[k] for k in by], "__bucket", "__value", "__count", "__before", "__here")
    inside = Window.partitionBy(*by, "__bucket").orderBy("__value").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("__before") + F.coalesce(F.sum("__count").over(inside), F.lit(0))
    rows = rows.withColumn("__first", first)
    mine = F.filter("__here", lambda r: (r >= F.col("__first")) & (r < F.col("__first") + F.col("__count")))
    return rows.select(*by, F.explode(mine).alias("__rank"), "__value")


def _place(p: Column) -> Column:
    return (F.col("__n") - 1).cast("double") * p


def quantile_table(df: DataFrame, value, probs: list[float], by: list[str] | tuple = (),
                   written: bool = False) -> DataFrame:
    """Exact quantiles in long form -> by..., q_index, p, quantile.

    ``written``: ``df`` is already a narrow written table and is read as it is.
    """
    by, probs = list(by), [float(p) for p in probs]
    if not probs:
        raise ValueError("probs must not be empty")
    values = df.select(*by, _col(value).cast("double").alias("__v")).where("__v IS NOT NULL AND NOT isnan(__v)")
    if not written:
        values = shared_table(values, "values")
    groups = shared_table(_groups(values, by, probs), "groups")
    counted = shared_table(_counted(values, groups, by, probs), "counted")
    found = _rank_values(counted, groups, by, probs)
    found = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__value"))).alias("__values"))
    spread = F.posexplode(F.array(*[F.lit(p) for p in probs])).alias("q_index", "p")
    out = _attached(groups.select(*by, "__n", spread), found, by).withColumn("__place", _place(F.col("p")))
    out = out.withColumns({"__r_lo": F.floor("__place"), "__r_hi": F.ceil("__place")})
    out = out.withColumns({f"__v_{s}": F.element_at("__values", F.col(f"__r_{s}")) for s in ("lo", "hi")})
    lo, hi = F.col("__v_lo"), F.col("__v_hi")
    between = ((F.col("__r_hi").cast("double") - F.col("__place")) * lo
               + (F.col("__place") - F.col("__r_lo").cast("double")) * hi)
    return out.select(*by, "q_index", "p", F.when(lo == hi, lo).otherwise(between).alias("quantile"))


def quantile_array(df: DataFrame, value, probs: list[float], by: list[str] | tuple = (),
                   name: str = "quantiles", written: bool = False) -> DataFrame:
    """The quantiles of each group as one array ordered like ``probs``.  -> by..., <name>."""
    by = list(by)
    parts = F.array_sort(F.collect_list(F.struct("q_index", "quantile")))
    return quantile_table(df, value, probs, by, written).groupBy(*by).agg(F.transform(parts, lambda s: s["quantile"]).alias(name))


def median_table(df: DataFrame, value, by: list[str] | tuple = (), name: str = "median",
                 written: bool = False) -> DataFrame:
    """Exact median per group.  -> by..., <name>."""
    by = list(by)
    return quantile_table(df, value, [0.5], by, written).select(*by, F.col("quantile").alias(name))
