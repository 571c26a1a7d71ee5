"""Totals, counts and top-k.

All aggregates are aliased; Spark plans each as a partial aggregate before the
shuffle and a final one after it, so a hot key is collapsed map-side and never
reaches one reducer as raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def total_per(df: DataFrame, keys: str | Sequence[str], value: Column | str, *,
              out: str = "total", count_out: str | None = None) -> DataFrame:
    """Sum of ``value`` per key (nulls skipped; all-null group gives null)."""
    aggs = [F.sum(_col(value)).alias(out)]
    if count_out:
        aggs.append(F.count(F.lit(1)).alias(count_out))
    return df.groupBy(*_keys(keys)).agg(*aggs)


def grand_total(df: DataFrame, value: Column | str, *, out: str = "total") -> DataFrame:
    """One row: the sum of ``value`` over all rows (null when there are none)."""
    return df.agg(F.sum(_col(value)).alias(out))


def count_per(df: DataFrame, keys: str | Sequence[str], *, out: str = "n",
              extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Row count per key, plus optional named aggregates."""
    aggs = [F.count(F.lit(1)).alias(out)]
    aggs += [c.alias(name) for name, c in (extra or {}).items()]
    return df.groupBy(*_keys(keys)).agg(*aggs)


def top_k(df: DataFrame, k: int, by: str, *, tie_break: str | Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ties resolved by ``tie_break`` ascending.

    Planned as TakeOrderedAndProject: every partition keeps its own k best rows,
    only those reach the final merge, so the cost is one pass plus k x tasks rows.
    """
    order = [F.col(by).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in _keys(tie_break)]
    return df.orderBy(*order).limit(k)


def top_k_total(df: DataFrame, k: int, by: str, *, tie_break: str | Sequence[str] = (),
                out: str = "top_total") -> DataFrame:
    """Sum of ``by`` over the top ``k`` rows (one row)."""
    return grand_total(top_k(df, k, by, tie_break=tie_break), by, out=out)
