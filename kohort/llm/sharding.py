"""Sharding by weighted rendezvous hashing (operator 2).

Every (key, shard) pair has a stable score; a key belongs to the shard with
its highest score.  With ``u`` a uniform hash in (0, 1) the score is
``-weight / ln(u)``, which gives each shard a share of the keys in proportion
to its weight.  A new shard only adds one more score per key, so a key either
stays where it is or moves to the new shard.

Defined cases: a null key counts as the empty string (all such rows share a
shard); a null text has size 1 and checksum 0; rows that repeat a key go to
the same shard and get slots of their own; an empty table gives no rows;
other columns are not read by the query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import number_rows, table

#: chunks per shard when slots are numbered; no task numbers more than one chunk at a time
SLOT_CHUNKS = 4096


def _score(key: Column, shard: int, weight: float) -> Column:
    h = F.xxhash64(F.coalesce(key.cast("string"), F.lit("")), F.lit(shard))
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)
    return F.lit(-float(weight)) / F.log(u)


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard number of ``key`` among ``len(weights)`` weighted shards (ties: the lowest)."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights: one positive number per shard")
    scores = F.array(*[_score(key, s, w) for s, w in enumerate(weights)])
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def shard_documents(docs: DataFrame, key: str, weights: Sequence[float],
                    grown: Sequence[float] | None = None) -> DataFrame:
    """``docs`` with ``shard`` and, when ``grown`` weights are given, ``grown_shard``."""
    out = docs.withColumn("shard", rendezvous_shard(F.col(key), weights))
    if grown is not None:
        out = out.withColumn("grown_shard", rendezvous_shard(F.col(key), grown))
    return out


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, each written by many tasks."""
    sharded.write.partitionBy("shard").parquet(path)


def op2_sharding(spark: SparkSession, sf_dir: str, shards: int = 8) -> DataFrame:
    """All ``documents`` over ``shards`` equal shards, and where they go with one more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = shard_documents(docs, "doc_id", [1.0] * shards, [1.0] * (shards + 1))
    chunk = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("slot")), F.lit(SLOT_CHUNKS)).cast("int")
    order = [F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    return number_rows(placed, "shard", chunk, order, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
