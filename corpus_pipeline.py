"""A training corpus from ``documents``: five stages, each one operator of ``kohort.llm``.

Every stage works on all rows that its predecessor kept; its result is
written to the shared folder and read again, so a lost executor never sends
the pipeline back further than the stage it is in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kohort.llm import exact_dedup, packing, quality_model, signature_trees, suffix_dedup
from kohort.llm.common import free_name, shared_table, ship_package, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship_package(spark)
    return quality_model.keep_good(docs, quality_model.fit_on_labels(spark, docs, sf_dir))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each different text."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of near copies: 80 % of their 5-word shingles are shared."""
    ship_package(spark)
    groups = signature_trees.jaccard_components(docs, words=5, percent=80)
    name = free_name(docs, "_goes")
    goes = groups.where("component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(goes, docs["doc_id"] == goes[name], "left_anti")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand earlier in the corpus."""
    ship_package(spark)
    return suffix_dedup.cut_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into training sequences."""
    ship_package(spark)
    return packing.packed(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("suffix-array dedup", passages),
    ("best-fit packing", sequences),
]

#: tokenising and compression have no SQL form; the tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
