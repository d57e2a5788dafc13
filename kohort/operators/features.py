"""Feature operators: ordinal encoding (M2), standard scaling (M3) and the
deterministic train/test split (M5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..sources.files import shared_table
from .aggregates import attach_scalars
from .categories import category_codes, encode


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# ------------------------------------------------------------------ M2
def fit_ordinal(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """M2 fit: categories in ascending order get codes 0..n-1, as a written
    dictionary (see :mod:`.categories`; any number of categories)."""
    return shared_table(category_codes(df, columns), "codes")


def apply_ordinal(df: DataFrame, codes: DataFrame, columns: list[str] | None = None,
                  unknown: int = config.UNKNOWN_CODE) -> DataFrame:
    """M2 transform: ``<col>_code`` INT per column; unseen values (and
    nulls) get ``unknown`` (-1)."""
    return encode(df, codes, columns, unknown)


def ordinal_encode(train: DataFrame, score: DataFrame | None = None,
                   columns: list[str] | None = None) -> DataFrame:
    """M2: fit on ``train`` and encode ``score`` (``train`` if omitted)."""
    return apply_ordinal(train if score is None else score, fit_ordinal(train, columns), columns)


# ------------------------------------------------------------------ M3
def fit_scaler(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """M3 fit: mean and population deviation per column -> one row."""
    columns = columns or config.NUMERICAL_FEATURES
    aggs = []
    for c in columns:
        x = F.col(_q(c)).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std")]
    return df.agg(*aggs)


def apply_scaler(df: DataFrame, stats: DataFrame, columns: list[str] | None = None,
                 digits: int | None = 6) -> DataFrame:
    """M3 transform: ``(x - mean) / std``; a constant column scales to 0."""
    columns = columns or config.NUMERICAL_FEATURES
    joined = attach_scalars(df, stats)
    scaled = {}
    for c in columns:
        z = F.try_divide(F.col(_q(c)).cast("double") - F.col(f"{c}__mean"), F.col(f"{c}__std"))
        z = F.when(F.col(f"{c}__std") == 0, F.lit(0.0)).otherwise(z)
        scaled[c] = F.round(z, digits) if digits is not None else z
    drop = [f"{c}__{s}" for c in columns for s in ("mean", "std")]
    return joined.withColumns(scaled).drop(*drop)


def standard_scale(df: DataFrame, columns: list[str] | None = None,
                   fit_on: DataFrame | None = None, digits: int | None = 6) -> DataFrame:
    """M3: z-scores with the population deviation (fit on ``fit_on``)."""
    return apply_scaler(df, fit_scaler(fit_on if fit_on is not None else df, columns), columns, digits)


# ------------------------------------------------------------------ M5
def split_flag(key: str = config.CUSTOMER_ID_COLUMN, test_size: float = config.TEST_SIZE,
               seed: int = config.SPLIT_SEED):
    """True for test rows: the first seven hex digits of ``md5(seed:key)``,
    modulo 10000, below ``test_size * 10000``.

    Depends only on the key, so the split is the same for any partitioning
    and survives recomputation after an executor loss; any engine with MD5
    can compute it.  A null key counts as the empty string.
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    bucket = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") % 10000
    return bucket < F.lit(int(round(test_size * 10000)))


def train_test_split(df: DataFrame, key: str = config.CUSTOMER_ID_COLUMN,
                     test_size: float = config.TEST_SIZE, seed: int = config.SPLIT_SEED):
    """M5: (train, test), disjoint and complete."""
    flag = split_flag(key, test_size, seed)
    return df.where(~flag), df.where(flag)


def with_split(df: DataFrame, key: str = config.CUSTOMER_ID_COLUMN,
               test_size: float = config.TEST_SIZE, seed: int = config.SPLIT_SEED) -> DataFrame:
    """M5 as a column: ``split`` = 'train' / 'test'."""
    return df.withColumn("split", F.when(split_flag(key, test_size, seed), "test").otherwise("train"))
