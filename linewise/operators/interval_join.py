"""Joins and counts of closed intervals of two tables.

Intervals are put into bins whose width fits their length: level ``j`` has bins
of ``2**j`` values, and an interval belongs to the level at which it touches at
most two bins.  A pair meets at the coarser of its two levels: the shorter
interval is also entered into the bins of every coarser level that the other
table uses (at most two bins a level, and there are at most 64 levels).  Two
intervals that share a point share the bin of the first shared point, and only
that bin reports the pair, so nothing has to be deduplicated.  Two short
intervals never meet in a wide bin, so candidates are pairs of which one covers
a fair part of the bin.

Bins that hold more than ``rows_per_bin`` rows of the left table are split: its
rows go to one of several shares by their hash, and the right table's rows of
the bin to each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from linewise.operators.sequence import _integral, _names, running_sum

RELATIONS = ("overlaps", "contains", "within")
#: Levels are this many bits apart: bins are at most ``2**LEVEL_STEP`` times as wide as they must be.
LEVEL_STEP = 2
DEFAULT_ROWS_PER_BIN = 1 << 17
#: The table of split bins is broadcast up to so many rows.
MAX_BROADCAST_BINS = 50_000
_WHOLE = {"byte", "short", "integer", "long"}


def same_kind(fields: Sequence[StructField]) -> None:
    """Raise unless all fields are whole numbers, all dates or all timestamps of one type."""
    kinds = {f.dataType.typeName() for f in fields}
    if not (kinds <= _WHOLE or kinds in ({"date"}, {"timestamp"}, {"timestamp_ntz"})):
        raise ValueError(f"integers, dates or timestamps of one kind are needed, not {sorted(kinds)}")


def _points(df: DataFrame, interval: Sequence[str], tag: str) -> DataFrame:
    """``<tag>lo`` and ``<tag>hi`` as longs in order; rows with a missing end go."""
    a, b = (_integral(df, name) for name in interval)
    return (df.withColumns({f"{tag}lo": F.least(a, b), f"{tag}hi": F.greatest(a, b)})
            .where(a.isNotNull() & b.isNotNull()))


def _level(lo: str, hi: str) -> Column:
    """The smallest level (a multiple of the step) whose bins are wider than the interval is long."""
    # A length beyond a long's range is null here and takes the widest bins.
    bits = F.length(F.bin(F.try_subtract(F.col(hi), F.col(lo))))
    stepped = F.ceil(bits / F.lit(LEVEL_STEP)) * LEVEL_STEP
    return F.least(F.coalesce(stepped, F.lit(63)), F.lit(63)).cast("int")


def _levels(df: DataFrame, tag: str) -> list[int]:
    return sorted(r[0] for r in df.select(f"{tag}level").distinct().collect())


def _entered(df: DataFrame, tag: str, own: str, other: str, levels: list[int], same: bool) -> DataFrame:
    """One row per (table whose level it is, level, bin): the own level under ``own``, coarser ones under ``other``.

    ``same``: whether an equal level of the other table counts as coarser.
    """
    level = F.col(f"{tag}level")
    wanted = F.array(*[F.lit(j) for j in levels]) if levels else F.array().cast("array<int>")
    coarser = F.filter(wanted, (lambda j: j >= level) if same else (lambda j: j > level))
    entries = F.concat(F.array(F.struct(F.lit(own).alias("side"), level.alias("level"))),
                       F.transform(coarser, lambda j: F.struct(F.lit(other).alias("side"), j.alias("level"))))
    spread = df.withColumn("__at", F.explode(entries))
    lo, hi = F.expr(f"shiftright({tag}lo, __at.level)"), F.expr(f"shiftright({tag}hi, __at.level)")
    return (spread.withColumn("__bin", F.explode(F.when(lo == hi, F.array(lo)).otherwise(F.array(lo, hi))))
            .select("*", F.col("__at.side").alias("__side"), F.col("__at.level").alias("__level")).drop("__at"))


def _shares(left: DataFrame, right: DataFrame, keys: list[str], rows_per_bin: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Split the bins that hold many rows of the left table; without such bins nothing is added."""
    hot = (left.groupBy(*keys).count().where(F.col("count") > rows_per_bin)
           .select(*[F.col(k).alias(f"__h{k}") for k in keys],
                   F.ceil(F.col("count") / rows_per_bin).cast("long").alias("__n")))
    known = hot.limit(MAX_BROADCAST_BINS + 1).collect()
    if not known:
        return left, right, keys
    if len(known) <= MAX_BROADCAST_BINS:  # a checked size: at most so many rows of a few numbers
        hot = F.broadcast(left.sparkSession.createDataFrame(known, hot.schema))
    match = [F.col(k) == F.col(f"__h{k}") for k in keys]
    gone = [f"__h{k}" for k in keys] + ["__n"]
    dealt = left.join(hot, match, "left").withColumn(
        "__share", F.coalesce(F.pmod(F.xxhash64(*left.columns), F.col("__n")), F.lit(0).cast("long"))).drop(*gone)
    copies = right.join(hot, match, "left").withColumn(
        "__share", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("__n"), F.lit(1).cast("long")) - 1))).drop(*gone)
    return dealt, copies, [*keys, "__share"]


def _renamed(df: DataFrame, tag: str) -> tuple[DataFrame, dict[str, str]]:
    names = {c: f"{tag}{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def interval_join(left: DataFrame, right: DataFrame, left_interval: Sequence[str], right_interval: Sequence[str], *,
                  relation: str = "overlaps", on: str | Sequence[str] | None = None, right_prefix: str = "right_",
                  rows_per_bin: int = DEFAULT_ROWS_PER_BIN) -> DataFrame:
    """Every pair of rows whose closed intervals meet; each pair of rows once.

    ``relation``: the left interval ``overlaps`` the right one (a shared end
    counts), ``contains`` it, or lies ``within`` it.  ``on`` names key columns
    of both tables that must be equal.  Ends may be integers, dates or
    timestamps of one kind; reversed ends are swapped, and a row with a missing
    end or key meets nothing.  Repeated rows give repeated pairs.  Columns of
    the right table that the left one also has get ``right_prefix``; the keys
    come from the left.
    """
    if relation not in RELATIONS:
        raise ValueError(f"relation must be one of {RELATIONS}")
    keys = _names(on)
    same_kind([left.schema[c] for c in left_interval] + [right.schema[c] for c in right_interval])
    a, of_a = _renamed(left, "__a")
    b, of_b = _renamed(right, "__b")
    a = _points(a, [of_a[c] for c in left_interval], "__a_").withColumn("__a_level", _level("__a_lo", "__a_hi"))
    b = _points(b, [of_b[c] for c in right_interval], "__b_").withColumn("__b_level", _level("__b_lo", "__b_hi"))
    a_levels, b_levels = _levels(a, "__a_"), _levels(b, "__b_")
    # Pairs of one level meet once, under the right table's level.
    a = _entered(a, "__a_", "left", "right", b_levels, True)
    b = _entered(b, "__b_", "right", "left", a_levels, False)
    for i, k in enumerate(keys):
        a, b = a.withColumn(f"__k{i}", F.col(of_a[k])), b.withColumn(f"__k{i}", F.col(of_b[k]))
    meet = ["__side", "__level", "__bin"] + [f"__k{i}" for i in range(len(keys))]
    a, b, meet = _shares(a, b, meet, rows_per_bin)
    joined = a.join(b, meet)
    test = {"overlaps": (F.col("__a_lo") <= F.col("__b_hi")) & (F.col("__b_lo") <= F.col("__a_hi")),
            "contains": (F.col("__a_lo") <= F.col("__b_lo")) & (F.col("__b_hi") <= F.col("__a_hi")),
            "within": (F.col("__b_lo") <= F.col("__a_lo")) & (F.col("__a_hi") <= F.col("__b_hi"))}[relation]
    first = F.expr("shiftright(greatest(__a_lo, __b_lo), __level)") == F.col("__bin")
    out = [F.col(of_a[c]).alias(c) for c in left.columns]
    for c in right.columns:
        if c not in keys:
            out.append(F.col(of_b[c]).alias(right_prefix + c if c in left.columns else c))
    return joined.where(test & first).select(*out)


def overlap_counts(left: DataFrame, right: DataFrame, left_interval: Sequence[str], right_interval: Sequence[str], *,
                   on: str | Sequence[str] | None = None, out: str = "n_overlaps", rows_per_bucket: int = 1 << 16) -> DataFrame:
    """Every left row with the number of right intervals that share a point with its own, without making the pairs.

    The intervals that start up to the own end, less those that end before the
    own start: two running counts along one order of all ends (see
    ``running_sum``), looked up by end and by start.  A row with a missing end
    or key counts 0.
    """
    keys = _names(on)
    same_kind([left.schema[c] for c in left_interval] + [right.schema[c] for c in right_interval])
    a, of_a = _renamed(left, "__a")
    b, of_b = _renamed(right, "__b")
    a_all = a.withColumns({"__a_lo": F.least(*[_integral(a, of_a[c]) for c in left_interval]),
                           "__a_hi": F.greatest(*[_integral(a, of_a[c]) for c in left_interval])})
    a = _points(a, [of_a[c] for c in left_interval], "__a_")
    b = _points(b, [of_b[c] for c in right_interval], "__b_")
    ka = [F.col(of_a[k]).alias(f"__k{i}") for i, k in enumerate(keys)]
    kb = [F.col(of_b[k]).alias(f"__k{i}") for i, k in enumerate(keys)]
    ks = [f"__k{i}" for i in range(len(keys))]

    def upto(query: str, end: str, step: int) -> DataFrame:
        # Points of the right table count before equal ones that are asked for (starts), or after them (ends).
        counted = (b.select(*kb, F.col(end).alias("__x")).groupBy(*ks, "__x").agg(F.count(F.lit(1)).alias("__c"))
                   .withColumn("__s", F.lit(step)))
        asked = a.select(*ka, F.col(query).alias("__x")).distinct().withColumns({"__c": F.lit(0).cast("long"), "__s": F.lit(1)})
        summed = running_sum(counted.unionByName(asked), "__c", ["__x", "__s"], out="__n", partition_by=ks or None,
                             rows_per_bucket=rows_per_bucket)
        return summed.where("__s = 1").select(*[F.col(k).alias(f"__q{k}") for k in ks], F.col("__x").alias(f"__q{query}"),
                                              F.col("__n").alias(f"__n{query}"))

    result = a_all
    for query, end, step in (("__a_hi", "__b_lo", 0), ("__a_lo", "__b_hi", 2)):
        table = upto(query, end, step)
        match = [F.col(f"__q{query}") == F.col(query)] + [F.col(f"__q{k}") == F.col(of_a[c]) for k, c in zip(ks, keys)]
        result = result.join(table, match, "left").drop(f"__q{query}", *[f"__q{k}" for k in ks])
    missing = F.lit(False)
    for c in left_interval:
        missing = missing | F.col(of_a[c]).isNull()
    n = F.when(missing, 0).otherwise(F.coalesce("__n__a_hi", F.lit(0)) - F.coalesce("__n__a_lo", F.lit(0)))
    return result.select(*[F.col(of_a[c]).alias(c) for c in left.columns], n.cast("long").alias(out))
