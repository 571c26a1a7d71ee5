"""Schema operators: prefix, rename, drop, each as one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefix_columns(df: DataFrame, prefix: str, *, only: Sequence[str] | None = None) -> DataFrame:
    """Prefix every column name (or those in ``only``)."""
    names = set(only) if only is not None else set(df.columns)
    return df.select([F.col(f"`{c}`").alias(prefix + c if c in names else c) for c in df.columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename several columns at once; names not present are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names not present are ignored."""
    return df.drop(*names)
