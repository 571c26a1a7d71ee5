"""Elements common to every row of a group (set intersection across rows).

Two plans give the same answer:

* ``fold``: ``collect_list`` the arrays of a group and intersect them in one
  expression.  Only for groups of a known small size (fixed-size batches).
* ``count``: explode the distinct elements of each row, count rows per
  (group, element) with a partial aggregate, keep elements whose count equals
  the group's row count.  No group is ever collected, so a group holding a
  third of all rows costs the same as many small ones.  The input is read twice
  (sizes and elements).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.functions.sets import fold_common

FOLD_MAX_GROUP = 64


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def group_common_elements(df: DataFrame, group: str | Sequence[str], arr: str, *,
                          out: str = "common", size_out: str | None = None,
                          strategy: str = "count", max_group_size: int | None = None) -> DataFrame:
    """One row per group with the sorted common elements (empty array if none).

    Null elements are ignored, and a null array counts as an empty row, so its
    group has no common element.  ``strategy="fold"`` requires
    ``max_group_size <= FOLD_MAX_GROUP``; ``"auto"`` picks fold only then.
    """
    keys = _keys(group)
    arr_type = df.schema[arr].dataType
    items = F.array_distinct(F.array_compact(F.coalesce(F.col(arr), F.array().cast(arr_type))))
    if strategy == "auto":
        small = max_group_size is not None and max_group_size <= FOLD_MAX_GROUP
        strategy = "fold" if small else "count"
    if strategy == "fold":
        if max_group_size is None or max_group_size > FOLD_MAX_GROUP:
            raise ValueError("fold needs a known group size bound <= FOLD_MAX_GROUP")
        # A group larger than the caller's bound fails the job.
        in_bound = F.count(F.lit(1)) <= max_group_size
        too_large = F.raise_error(F.lit(f"a group has more than max_group_size = {max_group_size} rows"))
        aggs = [F.when(in_bound, F.sort_array(fold_common(F.collect_list(items)))).otherwise(too_large).alias(out)]
        if size_out:
            aggs.append(F.count(F.lit(1)).alias(size_out))
        return df.groupBy(*keys).agg(*aggs)
    if strategy != "count":
        raise ValueError(f"unknown strategy {strategy!r}")

    # Partial aggregates shrink a hot group to one row (its size) and one row per
    # distinct element (its count) before each shuffle.  The join keeps the
    # elements that every row has, and adaptive execution may split a group with
    # very many elements there; only what is common, at most the elements of the
    # group's smallest row, is collected.
    n_col = size_out or "__lw_n"
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n_col))
    counted = (df.select(*keys, F.explode(items).alias("__lw_e"))
               .groupBy(*keys, "__lw_e").agg(F.count(F.lit(1)).alias("__lw_c")))
    named = sizes.select(*[F.col(k).alias(f"__lw_g{i}") for i, k in enumerate(keys)], F.col(n_col).alias("__lw_size"))
    same_group = [F.col(k).eqNullSafe(F.col(f"__lw_g{i}")) for i, k in enumerate(keys)]
    common = (counted.join(named, [*same_group, F.col("__lw_c") == F.col("__lw_size")])
              .groupBy(*[f"__lw_g{i}" for i in range(len(keys))])
              .agg(F.sort_array(F.collect_list("__lw_e")).alias("__lw_common")))
    result = sizes.join(common, same_group, "left")
    listed = F.coalesce("__lw_common", F.array().cast(arr_type)).alias(out)
    return result.select(*keys, listed, n_col) if size_out else result.select(*keys, listed)
