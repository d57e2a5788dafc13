"""Exact deduplication by an extendible-hash index on shared files (operator 4).

DataFrame functions only.

1. *Entries*: one row per document with a 64-bit key and the SHA-256 of its
   text, written once to the shared folder.
2. *Directory*: the leading bits of the key address a slot.  Doubling the
   directory once uses one more bit; a bucket whose entries hold more text
   than ``bucket_bytes`` is split at each doubling until it fits.  The
   greatest depth follows from the bytes of all texts (``depth_for``), so
   splitting ends early for a hot key only, whose copies share all bits.  The
   directory has at most ``2 ** DEPTH_LIMIT`` rows of three integers, so it
   can be broadcast; texts of more than that many buckets get larger buckets.
3. *Buckets*: texts are grouped by bucket, key and the text itself, so equal
   keys are compared byte by byte.  Map-side aggregation folds the copies of
   a hot text before anything is shuffled; one row per distinct text moves.
4. *Owners*: index nodes are range-partitioned by (bucket, key).  The owner
   of a key range numbers the chain of texts that collide on a key and
   writes its part of the index to the shared folder.
5. *Lookup*: entries meet the nodes on key and digest; a hot key is split by
   the adaptive skew join.

Defined cases: a null text counts as empty; the row with the largest doc_id
stays (a null doc_id is smaller than any); rows that repeat both doc_id and
text are all marked as kept, and ``drop_copies`` leaves the one that is
smallest in its other columns; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_name, shared_table, table

#: the directory's greatest depth, whatever the input: a million rows (12 MB)
DEPTH_LIMIT = 20
BUCKET_BYTES = 64 * 1024 * 1024
KEY_BITS = 64


def _keyed(docs: DataFrame, id_col: str, text_col: str, key_bits: int) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.xxhash64(text)
    if key_bits < 64:  # weak keys make collisions, for tests
        key = F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), key.alias("key"))


def _slot(max_depth: int):
    return F.shiftrightunsigned(F.col("key"), 64 - max_depth).cast("int")


def depth_for(total_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> tuple[int, int]:
    """(greatest depth, bucket bytes) for texts of ``total_bytes``: two bits more than even buckets need."""
    bucket_bytes = max(bucket_bytes, 4 * total_bytes >> DEPTH_LIMIT)
    need = max(1, -(-total_bytes // bucket_bytes))
    return min(DEPTH_LIMIT, (need - 1).bit_length() + 2), bucket_bytes


def directory(entries: DataFrame, max_depth: int,
              bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(slot, depth, bucket): the directory after the last doubling.

    ``depth`` is the bucket's local depth; a bucket is named by its first slot.
    """
    slots = (entries.groupBy(_slot(max_depth).alias("slot"))
             .agg(F.sum("n_bytes").alias("bytes")))
    levels = F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth")
    prefix = F.expr(f"slot - pmod(slot, cast(shiftleft(1, {max_depth} - depth) as int))")
    per_level = slots.select("slot", "bytes", levels).withColumn("bucket", prefix)
    load = per_level.groupBy("depth", "bucket").agg(F.sum("bytes").alias("load"))
    fits = (F.col("load") <= bucket_bytes) | (F.col("depth") == max_depth)
    return (per_level.join(load.where(fits), ["depth", "bucket"])
            .groupBy("slot").agg(F.min(F.struct("depth", "bucket")).alias("b"))
            .select("slot", "b.depth", "b.bucket"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_depth: int | None = None, bucket_bytes: int = BUCKET_BYTES,
                key_bits: int = KEY_BITS) -> tuple[DataFrame, DataFrame]:
    """``(entries, nodes)``, both written to the shared folder.

    entries: doc_id, key, sha256, n_bytes.  nodes: bucket, key, link (place
    in the key's chain, from 1), sha256, keep_id, group_size.
    """
    keyed = _keyed(docs, id_col, text_col, key_bits)
    sha = F.unhex(F.sha2(F.col("text"), 256))
    entries = shared_table(
        keyed.select("doc_id", "key", sha.alias("sha256"),
                     F.octet_length("text").cast("long").alias("n_bytes")), "dedup-entries")
    if max_depth is None:
        total = entries.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
        max_depth, bucket_bytes = depth_for(total, bucket_bytes)
    # at most 2 ** max_depth rows of three integers
    slots = F.broadcast(directory(entries, max_depth, bucket_bytes))
    texts = (keyed.withColumn("slot", _slot(max_depth)).join(slots, "slot")
             .groupBy("bucket", "key", "text")
             .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
             .select("bucket", "key", sha.alias("sha256"), "keep_id", "group_size"))
    chain = Window.partitionBy("bucket", "key").orderBy("sha256")
    nodes = (texts.repartitionByRange("bucket", "key")
             .withColumn("link", F.row_number().over(chain))
             .withColumn("before", F.lag("sha256").over(chain))
             # two texts with one digest would be told apart above, but not in the lookup
             .withColumn("sha256", F.when(F.col("before") == F.col("sha256"),
                                          F.raise_error(F.lit("two texts share a SHA-256")).cast("binary"))
                         .otherwise(F.col("sha256")))
             .select("bucket", "key", "link", "sha256", "keep_id", "group_size"))
    return entries, shared_table(nodes, "dedup-index")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **index) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, link."""
    entries, nodes = build_index(docs, id_col, text_col, **index)
    return entries.select("doc_id", "key", "sha256").join(nodes, ["key", "sha256"]).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"), "bucket", "link")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **index) -> DataFrame:
    """``docs`` with one row for each different text, all columns as they were."""
    _, nodes = build_index(docs, id_col, text_col, **index)
    names = docs.columns
    sha, keep, n = (free_name(docs, x) for x in ("_sha", "_keep", "_n"))
    stays = nodes.select(F.col("sha256").alias(keep + "sha"), F.col("keep_id").alias(keep))
    marked = docs.withColumn(
        sha, F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)))
    found = marked.join(stays, (marked[sha] == stays[keep + "sha"])
                        & marked[id_col].eqNullSafe(stays[keep]), "left_semi")
    # of rows equal in id and text the first in the order of the other columns stays
    others = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name not in (id_col, text_col) and "map<" not in f.dataType.simpleString()]
    first = Window.partitionBy(sha, F.col(f"`{id_col}`")).orderBy(*(others or [F.lit(0)]))
    return (found.withColumn(n, F.row_number().over(first)).where(F.col(n) == 1)
            .select(*[F.col(f"`{c}`") for c in names]))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
