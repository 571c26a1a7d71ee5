"""Closed integer intervals held in plain columns: containment and overlap.

These are row-local predicates; a null bound makes the predicate null and the
flag helpers turn that into 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalized(lo: Column | str, hi: Column | str) -> tuple[Column, Column]:
    """Order the two ends so that ``lo <= hi`` (reversed input is accepted)."""
    return F.least(_c(lo), _c(hi)), F.greatest(_c(lo), _c(hi))


def contains(a_lo, a_hi, b_lo, b_hi) -> Column:
    """``[a_lo, a_hi]`` contains ``[b_lo, b_hi]``."""
    return (_c(a_lo) <= _c(b_lo)) & (_c(a_hi) >= _c(b_hi))


def either_contains(a_lo, a_hi, b_lo, b_hi) -> Column:
    """One interval lies inside the other (touching ends count)."""
    return contains(a_lo, a_hi, b_lo, b_hi) | contains(b_lo, b_hi, a_lo, a_hi)


def overlaps(a_lo, a_hi, b_lo, b_hi) -> Column:
    """The intervals share at least one point."""
    return (_c(b_lo) <= _c(a_hi)) & (_c(a_lo) <= _c(b_hi))


def flag(predicate: Column) -> Column:
    """1 when the predicate is true, else 0 (null counts as false)."""
    return F.coalesce(predicate, F.lit(False)).cast("int")


def overlap_label(a_lo, a_hi, b_lo, b_hi, *, overlap: str = "overlap",
                  disjoint: str = "disjoint") -> Column:
    """``overlap`` / ``disjoint``; null when a bound is null."""
    ov = overlaps(a_lo, a_hi, b_lo, b_hi)
    return F.when(ov, F.lit(overlap)).when(~ov, F.lit(disjoint))
