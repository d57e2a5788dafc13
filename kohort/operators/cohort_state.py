"""Retention counts kept up to date: stored month words.

The state is the table of :func:`cohorts.month_words` by plan: one row per
(customer, plan, word of 62 months).  Words are sets, merged by a bitwise OR,
so a batch of new invoices is only folded to words and appended; reading
merges what was appended.  Batches can come in any order, a repeated batch
(a task or a job that ran twice) changes nothing, and the cost of a batch
does not depend on the size of the state.

A state folder holds versions ``v=N``.  Appends go to the newest complete
version; ``compact`` writes the merged words as the next one, which readers
see once Spark has committed it, and drops those before the one it read.  One
writer at a time; readers need no lock.

Invoices meet the subscriptions known when their batch comes; corrections
that take a month away need the state to be built anew.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from . import cohorts

SCHEMA = "customer_id long, subscription_type string, word int, bits long"


def _folders(spark: SparkSession, path: str) -> dict[int, bool]:
    """Versions below ``path``, and whether each is complete (metadata only)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    found = {}
    for status in fs.listStatus(root):
        m = re.fullmatch(r"v=(\d+)", status.getPath().getName())
        if m:
            found[int(m[1])] = fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
    return found


def _newest(spark: SparkSession, path: str) -> int:
    return max((v for v, done in _folders(spark, path).items() if done), default=0)


def append(invoices: DataFrame, subscriptions: DataFrame, path: str) -> None:
    """Fold a batch of invoices to words and add them to the state."""
    spark = invoices.sparkSession
    words = cohorts.month_words(invoices, subscriptions, with_plan=True)
    words.select(*[c.split(" ")[0] for c in SCHEMA.split(", ")]).write.mode("append").parquet(f"{path}/v={_newest(spark, path)}")


def words(spark: SparkSession, path: str) -> DataFrame:
    """The merged words of the state, for the ``*_from_words`` operators."""
    if not _folders(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return cohorts.merge_words(spark.read.schema(SCHEMA).parquet(f"{path}/v={_newest(spark, path)}"))


def compact(spark: SparkSession, path: str) -> int:
    """Write the merged words as a new version; returns its number."""
    now = _newest(spark, path)
    words(spark, path).write.mode("overwrite").parquet(f"{path}/v={now + 1}")
    jvm = spark.sparkContext._jvm
    for old in _folders(spark, path):
        if old < now:  # a reader may still be on the one just read
            p = jvm.org.apache.hadoop.fs.Path(f"{path}/v={old}")
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return now + 1
