"""Ordinal codes of categories, numbered on the cluster (M2).

The codes 0, 1, ... follow the ascending order of a column's different
values.  The values are never collected: they are range-partitioned and
written, every partition numbers its own, and partition sizes (a few numbers
per column and partition) give the shift.  So a column can have any number of
categories, and the dictionary is a table that can be kept.

Null is no category.  Encoding joins the dictionary column by column; Spark
sends a small one to every executor and sorts both sides for a large one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..sources.files import shared_table
from .aggregates import unpivot


def category_codes(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column_name, value, code (long): the dictionary of the columns' values."""
    columns = columns or config.ORDINAL_FEATURES
    values = (unpivot(df.select(*columns), [], columns, cast="STRING").where("value IS NOT NULL")
              .groupBy("column_name", "value").agg(F.lit(1).alias("__one")).drop("__one"))
    # written, so that a value's partition is the same for everything below
    dealt = shared_table(values.repartitionByRange("column_name", "value").withColumn("part", F.spark_partition_id()), "categories")
    before = Window.partitionBy("column_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (dealt.groupBy("column_name", "part").agg(F.count(F.lit(1)).alias("n"))
             .select(F.col("column_name").alias("__c"), F.col("part").alias("__p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")))
    own = Window.partitionBy("column_name", "part").orderBy("value")
    return (dealt.withColumn("own", F.row_number().over(own) - 1)
            .join(shift, (F.col("column_name") == F.col("__c")) & (F.col("part") == F.col("__p")))
            .select("column_name", "value", (F.col("shift") + F.col("own")).alias("code")))


def encode(df: DataFrame, codes: DataFrame, columns: list[str] | None = None,
           unknown: int = config.UNKNOWN_CODE) -> DataFrame:
    """``df`` with ``<col>_code`` INT per column; unseen values and nulls get ``unknown``."""
    for c in columns or config.ORDINAL_FEATURES:
        side = codes.where(F.col("column_name") == c).select(F.col("value").alias("__value"), F.col("code").alias("__code"))
        df = (df.join(side, df[c].cast("string") == side["__value"], "left")
              .withColumn(f"{c}_code", F.coalesce("__code", F.lit(unknown)).cast("int")).drop("__value", "__code"))
    return df
