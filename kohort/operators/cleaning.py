"""Projection and cleaning operators.

Imputation values are one row, inlined as scalars.  Cleaning writes the
deduplicated rows once and reads one row on the driver: which columns need a
median at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import parse_date
from ..functions.names import normalise_columns, rename_columns
from ..sources.files import shared_table
from .aggregates import attach_scalars, unpivot
from .quantiles import median_table

__all__ = ["normalise_columns", "rename_columns", "to_nullable_long", "parse_dates",
           "select_present", "drop_duplicates", "null_rows", "split_features_target",
           "clean", "fit_medians", "apply_medians"]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def to_nullable_long(df: DataFrame, column: str) -> DataFrame:
    """Cast a column to BIGINT; values that do not convert become null."""
    return df.withColumn(column, F.expr(f"try_cast({_q(column)} AS BIGINT)"))


def parse_dates(df: DataFrame, columns: list[str], fmt: str | None = None) -> DataFrame:
    """Parse string columns to DATE; invalid or empty values -> null."""
    return df.withColumns({c: parse_date(F.col(_q(c)), fmt) for c in columns})


def select_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep the listed columns that exist; all columns if none does."""
    present = [c for c in columns if c in df.columns]
    return df.select(*[_q(c) for c in present]) if present else df


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Full-row distinct (nulls compare equal)."""
    return df.dropDuplicates()


def null_rows(df: DataFrame, column: str, null: bool = True) -> DataFrame:
    """Rows where ``column`` is (or is not) null."""
    c = F.col(_q(column))
    return df.where(c.isNull() if null else c.isNotNull())


def split_features_target(df: DataFrame, target: str = config.TARGET_COLUMN):
    """P5: (features without the target, target with the id)."""
    ident = config.CUSTOMER_ID_COLUMN
    keep = [ident] if ident in df.columns else []
    return df.drop(target), df.select(*keep, target)


def fit_medians(df: DataFrame, numeric: list[str]) -> DataFrame:
    """Exact median of each numeric column -> one row ``<col>__median``.

    One exact-quantile pass over the long form (group = column); the small
    result is pivoted to one row with explicit column values.
    """
    long = unpivot(df, [], numeric).where(F.col("value").isNotNull())
    med = median_table(long, "value", ["column_name"])
    wide = med.groupBy().pivot("column_name", numeric).agg(F.first("median"))
    return wide.select(*[F.col(_q(c)).cast("double").alias(f"{c}__median") for c in numeric])


def apply_medians(df: DataFrame, medians: DataFrame, numeric: list[str]) -> DataFrame:
    """Fill nulls of each numeric column with its median; all numeric
    columns become DOUBLE (as an imputer's float output)."""
    joined = attach_scalars(df, medians)
    filled = {c: F.coalesce(F.col(_q(c)).cast("double"), F.col(f"{c}__median")) for c in numeric}
    return joined.withColumns(filled).drop(*[f"{c}__median" for c in numeric])


def clean(df: DataFrame, numeric: list[str] | None = None,
          categorical: list[str] | None = None, fill: str = config.CATEGORY_FILL,
          keep: list[str] | None = None) -> DataFrame:
    """M1: drop duplicate rows, then fill missing numeric values with the
    column median and missing categories with ``fill``.

    All listed numeric columns are returned as DOUBLE, whatever the data.
    ``keep``: the columns to go on with after the duplicates are gone.  The
    deduplicated rows are written once; the null check and the medians read
    them.
    """
    out = df.dropDuplicates()
    if keep is not None:
        out = select_present(out, keep)
    names = out.columns
    numeric = [c for c in (numeric or config.NUMERICAL_FEATURES) if c in names]
    categorical = [c for c in (categorical or config.ORDINAL_FEATURES) if c in names]
    out = shared_table(out, "clean")
    if numeric:
        counts = out.agg(*[F.count_if(F.col(_q(c)).isNull()).alias(f"n{i}") for i, c in enumerate(numeric)]).first()
        needs = [c for i, c in enumerate(numeric) if counts[f"n{i}"]]
        if needs:
            out = apply_medians(out, fit_medians(out, needs), needs)
        out = out.withColumns({c: F.col(_q(c)).cast("double") for c in numeric})
    if categorical:
        out = out.fillna(fill, subset=categorical)
    return out.select(*[_q(c) for c in names])
