"""Set algebra on array columns (within one row).

Spark's ``array_intersect`` / ``array_except`` deduplicate and keep the order of
the left array.  When more than one element can remain, "the first" depends on
that order, so ``first_common`` sorts before picking.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def common_elements(a: Column | str, b: Column | str) -> Column:
    """Distinct elements present in both arrays (left order)."""
    return F.array_intersect(_c(a), _c(b))


def without(a: Column | str, b: Column | str) -> Column:
    """Distinct elements of ``a`` missing from ``b``."""
    return F.array_except(_c(a), _c(b))


def common_by_difference(a: Column | str, b: Column | str) -> Column:
    """``a \\ (a \\ b)``: the same set as ``common_elements`` via two differences."""
    return without(a, without(a, b))


def fold_common(arrays: Column | str) -> Column:
    """Intersection of every array in an ``array<array<T>>`` (first one as the seed)."""
    arrs = _c(arrays)
    return F.aggregate(arrs, F.get(arrs, 0), lambda acc, x: F.array_intersect(acc, x))


def letters_only(arr: Column | str) -> Column:
    """Keep the items that are a single ASCII letter."""
    return F.filter(_c(arr), lambda x: x.rlike("^[A-Za-z]$"))


def first_common(arr: Column | str) -> Column:
    """Smallest element (binary order), null for an empty or null array."""
    return F.get(F.sort_array(_c(arr)), 0)


def joined_sorted(arr: Column | str, sep: str = "") -> Column:
    """Elements sorted and joined; an empty array gives ``''``."""
    return F.array_join(F.sort_array(_c(arr)), sep)
