"""Data-quality and validation operators (Q1-Q6).

Profiles are computed in one aggregate over all columns and returned in long
form, so adding columns never adds jobs.  Schema checks read only metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import percent
from ..sources.files import shared_table
from .aggregates import attach_scalars, unpivot


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


# ------------------------------------------------------------------ Q1
def missing_required_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Q1: the required columns absent from ``df`` -> column_name (empty
    when the frame is valid)."""
    missing = [c for c in required if c not in df.columns]
    schema = T.StructType([T.StructField("column_name", T.StringType(), False)])
    return _spark(df).createDataFrame([(c,) for c in missing], schema)


def has_required_columns(df: DataFrame, required: list[str]) -> bool:
    """Q1 as a boolean (metadata only)."""
    return all(c in df.columns for c in required)


# ------------------------------------------------------------------ Q2
# fixed values: the error texts of the schema check
COLUMN_MISSING = "Column missing"
TYPE_MISMATCH = "Type mismatch: expected {}, got {}"


def _type_name(t) -> str:
    if isinstance(t, T.DataType):
        return t.simpleString()
    return str(t).lower()


def validate_schema(df: DataFrame, expected: dict[str, str] | T.StructType) -> DataFrame:
    """Q2: per expected column PASSED or FAILED (missing, or another type),
    plus an ``__overall__`` row.  Types are compared exactly by their Spark
    names (``bigint``, ``double``, ``decimal(18,2)``...).

    -> column_name, status, expected_type, actual_type, error.
    """
    if isinstance(expected, T.StructType):
        expected = {f.name: f.dataType.simpleString() for f in expected.fields}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for name, want in expected.items():
        want = _type_name(want)
        have = actual.get(name)
        if have is None:
            rows.append((name, "FAILED", want, None, COLUMN_MISSING))
        elif have == want:
            rows.append((name, "PASSED", want, have, None))
        else:
            rows.append((name, "FAILED", want, have, TYPE_MISMATCH.format(want, have)))
    overall = "FAILED" if any(r[1] == "FAILED" for r in rows) else "PASSED"
    rows.append(("__overall__", overall, None, None, None))
    schema = T.StructType([
        T.StructField("column_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("expected_type", T.StringType(), True),
        T.StructField("actual_type", T.StringType(), True),
        T.StructField("error", T.StringType(), True),
    ])
    return _spark(df).createDataFrame(rows, schema)


# ------------------------------------------------------------------ Q3, Q6
def data_summary(df: DataFrame) -> DataFrame:
    """Q3/Q6: per column its type, non-null and null counts, and the row
    count, in one pass.  -> column_name, data_type, non_null, nulls, rows."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(F.col(_q(c))).alias(f"nn_{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', '{t}', nn_{i}"
                      for i, (c, t) in enumerate(df.dtypes))
    long = wide.select("__rows", F.expr(
        f"stack({len(df.columns)}, {parts}) AS (column_name, data_type, non_null)"))
    return long.select("column_name", "data_type", "non_null",
                       (F.col("__rows") - F.col("non_null")).alias("nulls"),
                       F.col("__rows").alias("rows"))


# ------------------------------------------------------------------ Q4
def feature_summary(df: DataFrame, numeric: list[str], categorical: list[str],
                    digits: int = 6) -> DataFrame:
    """Q4: numeric columns: mean, median, std, min, max, missing;
    categorical columns: number of distinct values and missing.

    The wanted columns are written once and read by one aggregate for all
    moments and counts and by the medians.  -> feature, kind, mean, median, std, min, max,
    unique_values, missing.  Top values: :func:`top_values`.
    """
    from .quantiles import median_table

    numeric = [c for c in numeric if c in df.columns]
    categorical = [c for c in categorical if c in df.columns]
    df = shared_table(df.select(*[_q(c) for c in dict.fromkeys(numeric + categorical)]), "features")
    aggs = []
    for i, c in enumerate(numeric):
        x = F.col(_q(c)).cast("double")
        aggs += [F.avg(x).alias(f"n{i}_mean"),
                 F.stddev_samp(x).alias(f"n{i}_std"), F.min(x).alias(f"n{i}_min"),
                 F.max(x).alias(f"n{i}_max"), F.count_if(x.isNull()).alias(f"n{i}_missing")]
    for i, c in enumerate(categorical):
        x = F.col(_q(c))
        aggs += [F.count_distinct(x).alias(f"c{i}_unique"), F.count_if(x.isNull()).alias(f"c{i}_missing")]
    wide = df.agg(*aggs)
    r = lambda col: f"round({col}, {digits})"
    rows = [f"'{c}', 'numerical', {r(f'n{i}_mean')}, {r(f'n{i}_std')}, "
            f"n{i}_min, n{i}_max, CAST(NULL AS BIGINT), n{i}_missing" for i, c in enumerate(numeric)]
    rows += [f"'{c}', 'categorical', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
             f"CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), c{i}_unique, c{i}_missing"
             for i, c in enumerate(categorical)]
    long = wide.select(F.expr(
        f"stack({len(rows)}, {', '.join(rows)}) AS "
        "(feature, kind, mean, std, min, max, unique_values, missing)"))
    if numeric:
        values = unpivot(df, [], numeric, "feature").where(F.col("value").isNotNull())
        med = median_table(values, "value", ["feature"]).withColumn(
            "median", F.round("median", digits))
        long = long.join(F.broadcast(med), "feature", "left")
    else:
        long = long.withColumn("median", F.lit(None).cast("double"))
    return long.select("feature", "kind", "mean", "median", "std", "min", "max",
                       "unique_values", "missing")


#: values that a heavy-hitter summary tracks per column
TRACKED = 10_000
#: a value with a larger share of a column's values than this is surely among a summary's: the summary's
#: error is at most 3.5 / size of its table, which holds a third more than the tracked values, and a
#: value is named when its lower bound is above that error
NAMED_SHARE = 2 * 3.5 * 0.75 / TRACKED


def top_values(df: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """Q4/A2/O3: the ``k`` most frequent values of each column (ties by
    value).  -> feature, value, count, rank.

    A mergeable summary per column (``approx_top_k``, bounded by ``TRACKED``
    values) names candidates, a second pass counts just these exactly.  So
    what is shuffled does not depend on the number of different values.  The
    answer is whole when the candidates' counts add up to all values, or the
    ``k``-th is larger than ``NAMED_SHARE`` of them; the other columns (nearly
    all values rare) are counted value by value.
    """
    long = shared_table(unpivot(df, [], columns, "feature", "value", cast="STRING").where(F.col("value").isNotNull()), "values")
    named = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(value, {TRACKED}, {TRACKED})").alias("top"))
    named = shared_table(named, "named")  # at most TRACKED values per column
    w = Window.partitionBy("feature").orderBy(F.desc("count"), F.asc("value"))

    def ranked(counts: DataFrame) -> DataFrame:
        return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    candidates = named.select("feature", F.explode("top.item").alias("value"))
    counts = shared_table(long.join(candidates, ["feature", "value"]).groupBy("feature", "value")
                          .agg(F.count(F.lit(1)).alias("count")), "counted")
    sums = counts.groupBy("feature").agg(F.sum("count").alias("found"))
    least = ranked(counts).where(F.col("rank") == k).select("feature", F.col("count").alias("least"))
    whole = (F.col("found") == F.col("n")) | (F.col("least") > NAMED_SHARE * F.col("n"))
    state = named.select("feature", "n").join(sums, "feature", "left").join(least, "feature", "left")
    rare = [r.feature for r in state.where(~F.coalesce(whole, F.lit(False))).select("feature").collect()]  # columns
    if rare:
        every = long.where(F.col("feature").isin(rare)).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
        counts = counts.where(~F.col("feature").isin(rare)).unionByName(every)
    return ranked(counts).orderBy("feature", "rank")


# ------------------------------------------------------------------ Q5, P9
def row_digests(df: DataFrame) -> list:
    """Two 64-bit hashes of a whole row.  Nulls add nothing to Spark's hash,
    so the places of the nulls are hashed as well."""
    parts = [F.col(_q(c)) for c in df.columns] + [F.col(_q(c)).isNull() for c in df.columns]
    return [F.xxhash64(*parts).alias("__h1"), F.xxhash64(F.lit("second"), *reversed(parts)).alias("__h2")]


def count_distinct_rows(df: DataFrame) -> DataFrame:
    """Different rows -> distinct_rows (one row).

    Only 128-bit digests are grouped.  Whole rows are compared just where a
    digest repeats, so a collision is told apart.  Columns that Spark
    cannot hash (maps) are not supported, as in ``distinct``.
    """
    digests = df.select(*row_digests(df)).groupBy("__h1", "__h2").agg(F.count(F.lit(1)).alias("__n"))
    digests = shared_table(digests, "digests")
    single = digests.where("__n = 1").agg(F.count(F.lit(1)).alias("single"))
    again = digests.where("__n > 1").select("__h1", "__h2")
    rows = df.select("*", *row_digests(df)).join(again, ["__h1", "__h2"], "left_semi").drop("__h1", "__h2").distinct()
    repeated = rows.agg(F.count(F.lit(1)).alias("repeated"))
    return attach_scalars(single, repeated).select((F.col("single") + F.col("repeated")).alias("distinct_rows"))


def quality_report(df: DataFrame) -> DataFrame:
    """Q5: rows, columns, duplicate rows and share, total missing and
    share, missing per column (only columns with any), distinct values per
    column, number of columns per type.

    -> section, item, value (DOUBLE).  Percentages are rounded to two digits
    (F12).  Missing and distinct values come from one count per (column,
    value) over the long form.
    """
    cols = df.columns
    ncols = len(cols)
    df = shared_table(df, "report")
    long = unpivot(df, [], cols, cast="STRING")
    values = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    per_column = shared_table(values.groupBy("column_name").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
        F.count("value").alias("different")), "report")
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    distinct_rows = count_distinct_rows(df)
    missing = per_column.agg(F.sum("missing").alias("total_missing"))
    wide = attach_scalars(attach_scalars(rows, distinct_rows), missing).withColumns({
        "duplicate_pct": percent(F.col("rows") - F.col("distinct_rows"), F.col("rows")),
        "missing_pct": percent(F.col("total_missing"), F.col("rows") * ncols)})
    type_counts: dict[str, int] = {}
    for _, t in df.dtypes:
        type_counts[t] = type_counts.get(t, 0) + 1
    items = [
        ("overview", "rows", "rows"),
        ("overview", "columns", str(ncols)),
        ("overview", "duplicate_rows", "rows - distinct_rows"),
        ("overview", "duplicate_pct", "duplicate_pct"),
        ("missing", "total_missing", "coalesce(total_missing, 0)"),
        ("missing", "missing_pct", "missing_pct"),
        *[("data_types", t, str(n)) for t, n in sorted(type_counts.items())],
    ]
    body = ", ".join(f"'{s}', '{i}', CAST({v} AS DOUBLE)" for s, i, v in items)
    overview = wide.select(F.expr(f"stack({len(items)}, {body}) AS (section, item, value)"))
    # only columns with missing values are listed
    by_column = per_column.where("missing > 0").select(
        F.lit("missing_by_column").alias("section"), F.col("column_name").alias("item"), F.col("missing").cast("double").alias("value"))
    unique = per_column.select(
        F.lit("unique_values").alias("section"), F.col("column_name").alias("item"), F.col("different").cast("double").alias("value"))
    return overview.unionByName(by_column).unionByName(unique)
