"""Samples without replacement, of exact size and equal on reruns.

Every row gets a priority from a hash of its key, so the sample depends on the
rows alone and not on how they are stored.  The rows of smallest priority are
taken; Spark keeps that many per task and stratum before it shuffles, so a
stratum that holds a third of all rows sends its best rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits of the hash that make a priority: 52 bits, exact in a double.
_DIGITS = 13


def _uniform(key: Sequence[str], seed: int) -> Column:
    """A number in (0, 1) from the key's hash; a null is a value of its own."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in key]
    digits = F.substring(F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *parts)), 1, _DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16 ** _DIGITS)


def sample_rows(df: DataFrame, n: int, key: str | Sequence[str], *, strata: str | Sequence[str] | None = None,
                weight: str | None = None, seed: int = 0) -> DataFrame:
    """``n`` rows (of each stratum; all, where there are fewer), drawn without replacement.

    ``key`` must tell rows apart; equal keys have equal chances and are taken
    together or by their order.  With ``weight`` a row's chance at each draw is
    in proportion to it (exponential priorities); rows whose weight is null or
    not above 0 are never taken.  A null stratum is a stratum.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    key = [key] if isinstance(key, str) else list(key)
    strata = [strata] if isinstance(strata, str) else list(strata or [])
    drawn = _uniform(key, seed)
    rows = df
    if weight:
        rows, drawn = df.where(F.col(weight) > 0), -F.log(drawn) / F.col(weight)
    ranked = rows.withColumn("__priority", drawn)
    if not strata:
        return ranked.orderBy("__priority", *key).limit(n).drop("__priority")
    order = Window.partitionBy(*strata).orderBy("__priority", *key)
    return (ranked.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= n)
            .drop("__priority", "__place"))
