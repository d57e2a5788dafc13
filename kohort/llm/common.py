"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.files import shared_table

__all__ = ["free_name", "held_out", "lowest_hashes", "number_rows", "shared_table", "ship_package", "sliced", "table", "tokenizer_path"]

TOKENIZER_FILE = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    """Default place of the vocabulary; every operator takes the path as a parameter."""
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER_FILE))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the executors import this package, wherever the driver was started (once per application)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="kohort-code-"), "kohort.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lowest_hashes(df: DataFrame, group: str, key: str, sizes: dict, k: int) -> DataFrame:
    """About the ``k`` rows with the lowest hash of ``key`` in each group, at most ``k``.

    ``sizes`` (rows per group) set a hash limit that some ``2 k`` rows of a
    group pass, so the ranking never sees more, whatever the input.
    """
    u = F.shiftrightunsigned(F.xxhash64(F.col(key)), 11).cast("double") / float(1 << 53)
    limits = [F.lit(x) for value, n in sizes.items() for x in (value, min(1.0, (2 * k + 20) / max(n, 1)))]
    limit = F.coalesce(F.create_map(*limits)[F.col(group)], F.lit(0.0)) if limits else F.lit(0.0)
    top = Window.partitionBy(group).orderBy("_u", key)
    return (df.withColumn("_u", u).where(F.col("_u") < limit)
            .withColumn("_n", F.row_number().over(top)).where(F.col("_n") <= k).drop("_n"))


def held_out(doc_id: Column) -> Column:
    """The third of the documents that no model may learn from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in small parts: bounds what a worker holds as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def number_rows(df: DataFrame, group: str, chunk: Column, order: list[Column], out: str) -> DataFrame:
    """Gapless numbers from 0 within every ``group``, in ``out``.

    ``chunk`` (a stable hash of the row's key) splits each group, so no task
    holds a whole group: rows are numbered within (group, chunk) and shifted
    by the number of rows in the group's earlier chunks.  The shifts are one
    row per (group, chunk).
    """
    part, n, shift, rank = (free_name(df, x) for x in ("_chunk", "_n", "_shift", "_rank"))
    df = df.withColumn(part, chunk)
    sizes = df.groupBy(group, part).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(group, part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(shift))
    inside = Window.partitionBy(group, part).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(inside).cast("long") - 1)
    return (ranked.join(shifts, [group, part])
            .withColumn(out, F.col(rank) + F.col(shift))
            .drop(part, rank, shift))
