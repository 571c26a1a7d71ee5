"""Planned sizes of inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimised plan (file sizes for a scan).

    None when the session does not expose plan statistics (Spark Connect);
    callers then take the conservative path.
    """
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:
        return None
    return int(size) if isinstance(size, int) else int(size.toString())
