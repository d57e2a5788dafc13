"""Scans of the input tables.

Tables are read lazily; Catalyst prunes columns and pushes filters into the
Parquet scan, so callers select only what they use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full-table scan of one input table (columns pruned by the plan)."""
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Lazy accessor for the tables of one data directory.

    ``Tables(spark, dir).orders`` returns the scan of ``orders.parquet``.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = read_table(self.spark, self.sf_dir, name)
        return self._frames[name]


def query_scan(spark: SparkSession, sql_text: str, views: dict[str, DataFrame],
               args: dict | None = None) -> DataFrame:
    """Run a SQL text over DataFrames, named in it as ``{name}``.

    ``args`` are bound as named parameters (``:name`` markers), never pasted
    into the text.  The frames are visible to this text only: views of the
    session with the same names are untouched.
    """
    return spark.sql(sql_text, args=args or None, **views)
