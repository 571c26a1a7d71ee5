"""Recoding through a dictionary table.

A literal map (``linewise.functions.recode``) suits a handful of codes.  When
the dictionary is a table it is joined instead.  It is broadcast only after its
row count is checked against ``max_broadcast_rows`` (a limited count, so the
check costs at most that many rows) and its planned size against
``max_broadcast_bytes``; above either the join is a shuffle join that AQE may
still turn into a broadcast at runtime.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.operators.partitioning import estimated_bytes

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def recode_join(df: DataFrame, key: str, dim: DataFrame, dim_key: str, dim_value: str, *,
                out: str, default=None,
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Left join ``df.key = dim.dim_key`` and add ``out`` (``default`` when unmatched).

    The dictionary must be unique on ``dim_key``; duplicates are collapsed to the
    smallest value so a row of ``df`` is never multiplied.
    """
    d = (dim.select(F.col(dim_key).alias("__lw_k"), F.col(dim_value).alias("__lw_v"))
         .where(F.col("__lw_k").isNotNull())
         .groupBy("__lw_k").agg(F.min("__lw_v").alias("__lw_v"))
         .withColumn("__lw_found", F.lit(True)))
    # The raw row count bounds the deduplicated one; the limit stops the count
    # as soon as the bound is exceeded, so a huge dictionary is not scanned.
    planned = estimated_bytes(dim.select(dim_key, dim_value))
    small = planned is not None and planned <= max_broadcast_bytes
    if small and dim.select(dim_key).limit(max_broadcast_rows + 1).count() <= max_broadcast_rows:
        d = F.broadcast(d)
    joined = df.join(d, df[key] == d["__lw_k"], "left")
    value = F.col("__lw_v") if default is None else F.when(F.col("__lw_found"), F.col("__lw_v")).otherwise(F.lit(default))
    return joined.withColumn(out, value).drop("__lw_k", "__lw_v", "__lw_found")
