"""File sources and sinks.

CSV is read with an explicit schema (no inference pass over the data);
Parquet is the preferred sink.  Sinks write through Spark's committers, so a
task lost to an executor failure is retried without partial output.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import checkpoint_dir

#: Spark's setting to drop shuffle files when the query that wrote them ends
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Schemas of the three business tables
SUBSCRIPTIONS = T.StructType([
    T.StructField("subscription_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("subscription_type", T.StringType()),
    T.StructField("contract_length", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("is_active", T.BooleanType()),
])
INVOICES = T.StructType([
    T.StructField("invoice_id", T.LongType()),
    T.StructField("subscription_id", T.LongType()),
    T.StructField("invoice_date", T.DateType()),
    T.StructField("amount", T.DecimalType(18, 2)),
    T.StructField("paid_late", T.BooleanType()),
    T.StructField("status", T.StringType()),
])
CUSTOMERS = T.StructType([
    T.StructField("customerid", T.LongType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("tenure", T.IntegerType()),
    T.StructField("usage_frequency", T.DoubleType()),
    T.StructField("support_calls", T.DoubleType()),
    T.StructField("payment_delay", T.DoubleType()),
    T.StructField("total_spend", T.DoubleType()),
    T.StructField("last_interaction", T.DoubleType()),
    T.StructField("subscription_type", T.StringType()),
    T.StructField("contract_length", T.StringType()),
    T.StructField("churn", T.IntegerType()),
])


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor never forces the work before this
    point to be repeated), and every later use reads the same rows, with
    column pruning and a known size.  The shuffle files of the finished
    write are no longer needed and are removed.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """S3: header CSV.  With ``schema`` values that do not parse become
    null (PERMISSIVE); without it all columns are read as strings, never
    inferred (inference is a full extra pass)."""
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Write a table (Parquet by default; ``csv`` with a header)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Report frame as JSON lines (one object per row)."""
    df.write.mode(mode).json(path)
    return path


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Read back a JSON report."""
    return spark.read.json(path)
