"""Wide to long (unpivot) and totals per unpivoted key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], *,
                 name: str = "metric", value: str = "value") -> DataFrame:
    """One row per (id row, value column); null cells are kept.

    Planned as ``Expand``: row-local, no shuffle.
    """
    return df.unpivot(list(ids), list(values), name, value)


def unpivot_totals(df: DataFrame, values: Sequence[str], *, name: str = "metric",
                   value: str = "value") -> DataFrame:
    """Per value column: total, rows, non-null rows, via the long form."""
    long = unpivot_long(df, [], values, name=name, value=value)
    return long.groupBy(name).agg(
        F.sum(value).alias("total"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value).alias("n_values"),
    )
