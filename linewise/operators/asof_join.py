"""As-of join: to each row, the nearest earlier (or later) row of another table.

Both tables are laid along one time order, cut into buckets of that order (see
``sequence``), so a key that holds many rows is split by time.  Inside a bucket a
window carries the last row of the other table forward; each bucket's last such
row is carried over the borders, key by key, in a table of one row per key and
bucket.  No pair of rows is ever made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linewise.operators.interval_join import same_kind
from linewise.operators.sequence import DEFAULT_MAX_BUCKETS, DEFAULT_ROWS_PER_BUCKET, _bucketed, _integral, _names


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, *,
              on: str | Sequence[str] | None = None, values: Sequence[str] | None = None, direction: str = "backward",
              exact: bool = True, within: int | None = None, prefix: str = "asof_",
              rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, max_buckets: int = DEFAULT_MAX_BUCKETS) -> DataFrame:
    """Every left row with the columns ``values`` (all but ``on`` by default) of the right row nearest before it in time.

    ``direction="forward"`` takes the nearest after it; ``exact`` decides
    whether an equal time counts.  ``on`` names key columns of both tables.
    ``within`` bounds the distance, in units of the time as a whole number
    (days of a date, microseconds of a timestamp).  Of right rows at one time
    the largest by ``values``, compared in that order, counts.  Left rows stay
    as they are, repeated ones too; without a match, with a null time or key,
    the values are null.  Value columns are named ``prefix`` + name.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction is 'backward' or 'forward'")
    keys = _names(on)
    values = [c for c in right.columns if c not in keys] if values is None else list(values)
    out_names = [prefix + v for v in values]
    clash = set(out_names) & set(left.columns)
    if clash:
        raise ValueError(f"value columns clash with the left table: {sorted(clash)}")
    same_kind([left.schema[left_time], right.schema[right_time]])
    sign = 1 if direction == "backward" else -1
    a, b = left.toDF(*[f"__l{i}" for i in range(len(left.columns))]), right
    at = {c: f"__l{i}" for i, c in enumerate(left.columns)}
    ta, tb = _integral(a, at[left_time]), _integral(b, right_time)
    ks = [f"__k{i}" for i in range(len(keys))]
    asked = a.select(F.struct(*a.columns).alias("__row"), *[F.col(at[k]).alias(n) for k, n in zip(keys, ks)],
                     (ta * sign).alias("__t"), F.lit(1).alias("__side"))
    found = b.where(tb.isNotNull())
    for k in keys:
        found = found.where(F.col(f"`{k}`").isNotNull())
    hit = F.struct((tb * sign).alias("t"), *[F.col(f"`{v}`").alias(f"v{i}") for i, v in enumerate(values)])
    found = found.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, ks)], (tb * sign).alias("__t"),
                         F.lit(0 if exact else 2).alias("__side"), hit.alias("__hit"))
    both = asked.unionByName(found, allowMissingColumns=True)
    framed, bucket, _ = _bucketed(both, ["__t"], None, rows_per_bucket, max_buckets)
    along = (Window.partitionBy(*ks, *bucket).orderBy("__t", "__side", "__hit")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    near = framed.withColumn("__near", F.last("__hit", ignorenulls=True).over(along)).where("__side = 1")
    # The last hit of every bucket, then of all earlier buckets of the key.
    earlier = Window.partitionBy(*ks).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    borders = (framed.groupBy(*ks, *bucket).agg(F.max("__hit").alias("__end"))
               .withColumn("__before", F.max("__end").over(earlier))
               .select(*[F.col(c).alias(f"__b{c}") for c in (*ks, *bucket)], "__before"))
    same = [F.col(c).eqNullSafe(F.col(f"__b{c}")) for c in (*ks, *bucket)]
    joined = near.join(borders, same, "left").withColumn("__found", F.coalesce("__near", "__before"))
    usable = F.col("__found").isNotNull() & F.col("__t").isNotNull()
    for k in ks:
        usable = usable & F.col(k).isNotNull()
    if within is not None:
        usable = usable & (F.col("__t") - F.col("__found.t") <= F.lit(within))
    return joined.select(*[F.col(f"__row.{at[c]}").alias(c) for c in left.columns],
                         *[F.when(usable, F.col(f"__found.v{i}")).alias(n) for i, n in enumerate(out_names)])
