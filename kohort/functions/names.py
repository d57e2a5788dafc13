"""Column-name helpers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

#: fixed values: characters that become an underscore (no camelCase split)
SEPARATORS = " -"


def normalise_name(name: str) -> str:
    """P1 on one name: ``" Last Interaction "`` -> ``last_interaction``."""
    return "".join("_" if c in SEPARATORS else c for c in name.strip().lower())


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename every column by :func:`normalise_name` (metadata only)."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def snake_case(name: str) -> str:
    """PascalCase -> snake_case: ``SubscriptionID`` -> ``subscription_id``."""
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    return s.lower()


def rename_columns(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename by an explicit mapping, or PascalCase -> snake_case."""
    if mapping is None:
        mapping = {c: snake_case(c) for c in df.columns}
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
