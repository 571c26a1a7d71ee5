"""Ranks, tiles, neighbours and moving frames over a whole order.

Ranks are properties of distinct order keys: rows are counted per key (with
partial aggregates, so a key that a third of all rows share is one row a task),
the counts are summed along the order by ``running_sum``, and each row looks its
key up.  No window ever sees the ties.

Neighbours (lag, lead) and moving frames need rows of other buckets.  Every
bucket gets copies of the rows just before and after it (its halo); a window
inside the bucket then sees all rows of a frame, and results are kept for the
bucket's own rows only.  With partitions, only those of more than
``rows_per_bucket`` rows are cut into buckets and have halos; a smaller one is a
bucket by itself, so that many small partitions, each spread over the whole
order, make no copies.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewise.operators.interval_join import MAX_BROADCAST_BINS, interval_join
from linewise.operators.sequence import (_BUCKET, DEFAULT_MAX_BUCKETS, DEFAULT_ROWS_PER_BUCKET, _bucketed, _integral,
                                         _key_stats, _names, row_number, running_sum)

RANKS = ("rank", "dense_rank", "percent_rank", "cume_dist")
#: Rows of each cut partition that a bucket holds on average, or more: its halo is small beside them.
LEAST_SLOT_ROWS = 256


def ranks(df: DataFrame, order_by: str | Sequence[str], *, partition_by: str | Sequence[str] | None = None,
          descending: bool = False, out: Mapping[str, str] | None = None,
          rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, max_buckets: int = DEFAULT_MAX_BUCKETS) -> DataFrame:
    """Add ranks of each row's order key among all rows (of its partition).

    ``out`` maps a kind of ``RANKS`` to the new column's name; the default adds
    ``rank`` and ``dense_rank``.  Nulls come first in ascending order and last in
    descending order; ``descending`` turns the order of all columns.  Equal keys
    have equal ranks, as in SQL.
    """
    wanted = dict(out or {"rank": "rank", "dense_rank": "dense_rank"})
    if unknown := set(wanted) - set(RANKS):
        raise ValueError(f"unknown ranks {sorted(unknown)}")
    order, parts = _names(order_by), _names(partition_by)
    opts = {"partition_by": parts or None, "rows_per_bucket": rows_per_bucket, "max_buckets": max_buckets}
    keys = df.groupBy(*parts, *order).agg(F.count(F.lit(1)).alias("__n"))
    table = running_sum(keys, "__n", order, out="__upto", **opts)
    if "dense_rank" in wanted:
        table = row_number(table, order, out="__dense", **opts)
    totals = keys.groupBy(*parts).agg(F.sum("__n").alias("__all"), F.count(F.lit(1)).alias("__keys"))
    if parts:
        totals = totals.select(*[F.col(c).alias(f"__t{i}") for i, c in enumerate(parts)], "__all", "__keys")
        table = table.join(totals, [F.col(c).eqNullSafe(F.col(f"__t{i}")) for i, c in enumerate(parts)])
    else:
        table = table.join(F.broadcast(totals))  # one row
    n, upto = F.col("__all"), F.col("__upto")
    before = (n - upto) if descending else (upto - F.col("__n"))
    dense = (F.col("__keys") - F.col("__dense") + 1) if descending else F.col("__dense")
    value = {"rank": (before + 1).cast("long"),
             "dense_rank": dense.cast("long") if "dense_rank" in wanted else None,
             "percent_rank": F.when(n > 1, before / (n - 1)).otherwise(F.lit(0.0)),
             "cume_dist": (before + F.col("__n")) / n}
    looked = table.select(*[F.col(c).alias(f"__r{i}") for i, c in enumerate([*parts, *order])],
                          *[value[kind].alias(f"__v{i}") for i, kind in enumerate(wanted)])
    same = [F.col(c).eqNullSafe(F.col(f"__r{i}")) for i, c in enumerate([*parts, *order])]
    joined = df.join(looked, same)
    return joined.select(*[F.col(c) for c in df.columns if c not in wanted.values()],
                         *[F.col(f"__v{i}").alias(name) for i, name in enumerate(wanted.values())])


def tiles(df: DataFrame, n: int, order_by: str | Sequence[str], *, out: str = "tile",
          partition_by: str | Sequence[str] | None = None, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
          max_buckets: int = DEFAULT_MAX_BUCKETS) -> DataFrame:
    """Cut the order (unique within a partition) into ``n`` tiles of nearly equal size; earlier tiles get the odd rows."""
    if n < 1:
        raise ValueError("n must be at least 1")
    parts = _names(partition_by)
    numbered = row_number(df, order_by, out="__rn", partition_by=parts or None, rows_per_bucket=rows_per_bucket,
                          max_buckets=max_buckets)
    totals = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("__all"))
    totals = totals.select(*[F.col(c).alias(f"__t{i}") for i, c in enumerate(parts)], "__all")
    if parts:
        joined = numbered.join(totals, [F.col(c).eqNullSafe(F.col(f"__t{i}")) for i, c in enumerate(parts)])
    else:
        joined = numbered.join(F.broadcast(totals))  # one row
    # The first `odd` tiles hold one row more than the others.
    small, odd = F.expr(f"__all div {int(n)}"), F.expr(f"__all % {int(n)}")
    at = F.col("__rn") - 1
    wide = odd * (small + 1)
    tile = F.when(at < wide, F.floor(at / (small + 1))).otherwise(odd + F.floor((at - wide) / F.greatest(small, F.lit(1)))) + 1
    return joined.select(*[F.col(c) for c in df.columns if c != out], tile.cast("long").alias(out))


def _edges(framed: DataFrame, parts: list[str], bucket: list[str], order: list[str], before: int, after: int) -> DataFrame:
    """Copies of rows for the buckets whose frames reach them, with ``bucket`` set to that bucket.

    A bucket's last ``before`` rows and first ``after`` rows are numbered along
    the whole order from the bucket sizes; the numbers that another bucket's
    frames reach are an interval, so an interval join deals the copies out, also
    over buckets with fewer rows than the frame.
    """
    slots = [*parts, *bucket]
    sizes = framed.groupBy(*slots).agg(F.count(F.lit(1)).alias("__size"))
    along = Window.partitionBy(*parts).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = sizes.withColumn("__end", F.sum("__size").over(along)).withColumn("__start", F.col("__end") - F.col("__size"))
    copies = None
    for count, back in ((before, True), (after, False)):
        if not count:
            continue
        # Row numbers from the bucket's end (rows that later buckets need) or start; only edge rows are shuffled.
        direction = [F.col(c).desc() for c in order] if back else [F.col(c) for c in order]
        edge = (framed.withColumn("__p", F.row_number().over(Window.partitionBy(*slots).orderBy(*direction)))
                .where(F.col("__p") <= count))
        own = places.select(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(slots)], "__start", "__end")
        edge = edge.join(own, [F.col(c).eqNullSafe(F.col(f"__o{i}")) for i, c in enumerate(slots)])
        number = (F.col("__end") - F.col("__p")) if back else (F.col("__start") + F.col("__p") - 1)
        # A null partition is a key like any other.
        group = F.xxhash64(*[F.col(c) for c in parts]) if parts else F.lit(0).cast("long")
        edge = edge.withColumns({"__at": number, "__group": group}).drop("__start", "__end", "__p",
                                                                         *[f"__o{i}" for i in range(len(slots))])
        lo, hi = (F.col("__start") - count, F.col("__start") - 1) if back else (F.col("__end"), F.col("__end") + count - 1)
        reach = places.select(*[F.col(c).alias(f"__n{i}") for i, c in enumerate(slots)], group.alias("__group"),
                              lo.alias("__lo"), hi.alias("__hi"))
        met = interval_join(edge, reach, ("__at", "__at"), ("__lo", "__hi"), on="__group")
        for i, c in enumerate(parts):
            met = met.where(F.col(c).eqNullSafe(F.col(f"__n{i}")))
        moved = met.select(*[F.col(c) for c in framed.columns if c not in bucket],
                           *[F.col(f"__n{len(parts) + i}").alias(c) for i, c in enumerate(bucket)])
        copies = moved if copies is None else copies.unionByName(moved)
    return copies


def _with_halos(df: DataFrame, parts: list[str], order: list[str], before: int, after: int, rows_per_bucket: int,
                max_buckets: int) -> tuple[DataFrame, list[str]]:
    """Rows with ``__own`` and their halo copies without it, and the columns (with the buckets') that windows are partitioned by.

    There are no copies and no buckets when each partition has ``rows_per_bucket`` rows at most.
    """
    whole, cut = None, df
    if parts:
        large = (df.groupBy(*parts).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_bucket)
                 .select(*[F.col(c).alias(f"__h{i}") for i, c in enumerate(parts)]))
        known = large.limit(MAX_BROADCAST_BINS + 1).collect()
        if not known:
            return df.withColumn("__own", F.lit(True)), parts
        n_large = len(known)
        if n_large <= MAX_BROADCAST_BINS:  # a checked size: at most so many keys
            large = F.broadcast(df.sparkSession.createDataFrame(known, large.schema))
        else:
            n_large = large.count()
        same = [F.col(c).eqNullSafe(F.col(f"__h{i}")) for i, c in enumerate(parts)]
        whole, cut = df.join(large, same, "left_anti"), df.join(large, same, "left_semi")
        # Buckets are ranges of the order, which all cut partitions share.
        rows_per_bucket = max(rows_per_bucket, min(rows_per_bucket, LEAST_SLOT_ROWS) * n_large)
    framed, bucket, _ = _bucketed(cut, order, None, rows_per_bucket, max_buckets)
    own = framed.withColumn("__own", F.lit(True))
    copies = _edges(framed, parts, bucket, order, before, after)
    if copies is not None:
        own = own.unionByName(copies.withColumn("__own", F.lit(False)))
    if whole is not None:
        own = own.unionByName(whole.withColumns({**{c: F.lit(0).cast("long") for c in bucket}, "__own": F.lit(True)}))
    return own, [*parts, *bucket]


def moving(df: DataFrame, columns: Mapping[str, Column], order_by: str | Sequence[str], *, rows: tuple[int, int],
           partition_by: str | Sequence[str] | None = None, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
           max_buckets: int = DEFAULT_MAX_BUCKETS) -> DataFrame:
    """Add aggregates over the rows from ``rows[0]`` to ``rows[1]`` around each row (-6 to 0: it and the six before).

    ``columns`` maps a new name to an aggregate such as ``F.sum("v")``.  The
    order must be unique within a partition.  A bucket's task holds its own rows
    and the frame's width on either side.
    """
    low, high = int(rows[0]), int(rows[1])
    if low > high:
        raise ValueError("the frame starts after it ends")
    order, parts = _names(order_by), _names(partition_by)
    own, slots = _with_halos(df, parts, order, max(0, -low), max(0, high), rows_per_bucket, max_buckets)
    frame = Window.partitionBy(*slots).orderBy(*order).rowsBetween(low, high)
    kept = [c for c in df.columns if c not in columns]
    return own.select(*kept, "__own", *[c.over(frame).alias(name) for name, c in columns.items()]).where("__own").drop("__own")


def neighbours(df: DataFrame, columns: Mapping[str, tuple[str, int]], order_by: str | Sequence[str], *,
               partition_by: str | Sequence[str] | None = None, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
               max_buckets: int = DEFAULT_MAX_BUCKETS) -> DataFrame:
    """Add values of rows a fixed number of places away: ``{"previous": ("v", -1), "next": ("v", 1)}``.

    Null where there is no such row; the order must be unique within a partition.
    """
    order, parts = _names(order_by), _names(partition_by)
    steps = [int(k) for _, k in columns.values()]
    own, slots = _with_halos(df, parts, order, max(0, -min(steps, default=0)), max(0, max(steps, default=0)),
                             rows_per_bucket, max_buckets)
    near = Window.partitionBy(*slots).orderBy(*order)
    kept = [c for c in df.columns if c not in columns]
    made = [F.lag(F.col(c), -int(k)).over(near).alias(name) for name, (c, k) in columns.items()]
    return own.select(*kept, "__own", *made).where("__own").drop("__own")


def moving_range(df: DataFrame, columns: Mapping[str, Column], order_by: str, *, within: tuple[int, int],
                 partition_by: str | Sequence[str] | None = None, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
                 max_buckets: int = DEFAULT_MAX_BUCKETS) -> DataFrame:
    """Add aggregates over all rows whose key lies from ``within[0]`` to ``within[1]`` of the row's own key.

    The key is an integer, a date (days) or a timestamp (microseconds); equal
    keys share a frame, and rows with a null key are each other's frame, as in
    SQL.  Buckets are key ranges at least as wide as the frame, so a row is
    copied to one neighbour on either side at most; a bucket holds the rows of
    its range, which is not less than the frame itself.
    """
    low, high = int(within[0]), int(within[1])
    if low > high:
        raise ValueError("the frame starts after it ends")
    parts = _names(partition_by)
    key = _integral(df, order_by)
    if key is None:
        raise ValueError("the order must be an integer, a date or a timestamp")
    framed = df.withColumn("__key", key)
    lo, hi, n, _ = _key_stats(framed, "__key")
    lo, hi = (0, 0) if lo is None else (lo, hi)
    n_buckets = max(1, min(max_buckets, -(-n // rows_per_bucket)))
    width = max(1, -(-(hi - lo + 1) // n_buckets), abs(low), abs(high))
    at = F.expr(f"(__key - {int(lo)}L) div {width}L")
    # Bucket and neighbours whose frames may hold the row; a null key has a bucket of its own.
    last = (hi - lo) // width
    reach = [at] + ([at + 1] if low < 0 else []) + ([at - 1] if high > 0 else [])
    places = F.when(F.col("__key").isNull(), F.array(F.lit(-2).cast("long"))).otherwise(
        F.filter(F.array(*reach), lambda b: b.between(0, last)))
    spread = framed.withColumn(_BUCKET, F.explode(places))
    own = F.when(F.col("__key").isNull(), F.lit(True)).otherwise(F.col(_BUCKET) == at)
    frame = Window.partitionBy(*parts, _BUCKET).orderBy("__key").rangeBetween(low, high)
    kept = [c for c in df.columns if c not in columns]
    return (spread.withColumn("__own", own)
            .select(*kept, "__own", *[c.over(frame).alias(name) for name, c in columns.items()])
            .where("__own").drop("__own"))


def ends(df: DataFrame, columns: Mapping[str, tuple[str, str]], order_by: str | Sequence[str], *,
         partition_by: str | Sequence[str] | None = None) -> DataFrame:
    """Add the first or last value along the order: ``{"opened": ("v", "first"), "closed": ("v", "last")}``.

    The value of the first (last) row, null or not; one aggregated row per
    partition is joined back.  Of rows that tie, the smallest (largest) value counts.
    """
    order, parts = _names(order_by), _names(partition_by)
    made = []
    for i, (c, which) in enumerate(columns.values()):
        row = F.struct(*[F.col(o) for o in order], F.col(c).alias("__value"))
        made.append((F.min(row) if which == "first" else F.max(row))["__value"].alias(f"__e{i}"))
    found = df.groupBy(*parts).agg(*made)
    kept = [F.col(c) for c in df.columns if c not in columns]
    values = [F.col(f"__e{i}").alias(name) for i, name in enumerate(columns)]
    if not parts:
        return df.join(F.broadcast(found)).select(*kept, *values)  # one row
    found = found.select(*[F.col(c).alias(f"__t{i}") for i, c in enumerate(parts)], *[f"__e{i}" for i in range(len(made))])
    same = [F.col(c).eqNullSafe(F.col(f"__t{i}")) for i, c in enumerate(parts)]
    return df.join(found, same).select(*kept, *values)
