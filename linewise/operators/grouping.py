"""Several groupings at once, with exact distinct counts.

Rows are first reduced to one per combination of all keys and counted value, so
the copies that the groupings need are made of that table and not of the rows.
Each (grouping, keys, value) then becomes one row, spread over tasks by the
value too, and only counts of such rows reach a group: a group that holds a
third of all rows never comes to one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rollup_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(keys[:n]) for n in range(len(keys), -1, -1)]


def cube_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    return [c for n in range(len(keys), -1, -1) for c in combinations(keys, n)]


def grouped_sets(df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], *, distinct: str | None = None,
                 sums: Mapping[str, str] | None = None, count_out: str = "n_rows", distinct_out: str = "n_distinct",
                 id_out: str = "grouping_id") -> DataFrame:
    """Row counts, distinct values of ``distinct`` and sums (new name -> column) for each grouping of ``sets``.

    One row per grouping and key combination that occurs; keys outside a
    grouping are null, and ``id_out`` tells them from null keys: as in SQL, a
    bit is 1 for each key left out, the first key's bit being the highest.  A
    null counts as no distinct value, and a null adds nothing to a sum.  The
    grand total of an empty table has no row.
    """
    keys, sums = list(keys), dict(sums or {})
    if any(set(s) - set(keys) for s in sets):
        raise ValueError("a grouping names a key that is not among the keys")
    base = df.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                     (F.col(distinct) if distinct else F.lit(None).cast("int")).alias("__v"),
                     *[F.col(c).alias(f"__s{i}") for i, c in enumerate(sums.values())])
    ks, ss = [f"__k{i}" for i in range(len(keys))], [f"__s{i}" for i in range(len(sums))]
    total = [F.sum("__n").alias("__n"), *[F.sum(s).alias(s) for s in ss]]
    fine = base.groupBy(*ks, "__v").agg(F.count(F.lit(1)).alias("__n"), *[F.sum(s).alias(s) for s in ss])
    ids = sorted({sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s) for s in sets})
    spread = fine.withColumn("__g", F.explode(F.array(*[F.lit(g) for g in ids])))
    masked = [F.when(F.col("__g").bitwiseAND(1 << (len(keys) - 1 - i)) == 0, F.col(k)).alias(k) for i, k in enumerate(ks)]
    once = spread.select("__g", *masked, "__v", "__n", *ss).groupBy("__g", *ks, "__v").agg(*total)
    out = once.groupBy("__g", *ks).agg(*total, F.count("__v").alias("__d"))
    return out.select(*[F.col(a).alias(b) for a, b in zip(ks, keys)], F.col("__g").cast("int").alias(id_out),
                      F.col("__n").alias(count_out), *([F.col("__d").alias(distinct_out)] if distinct else []),
                      *[F.col(a).alias(b) for a, b in zip(ss, sums)])
