"""Order-sensitive operators over a total order: running sums, row numbers,
boundary ("gaps and islands") groups and fixed-size batches.

A plain ``Window.orderBy(key)`` with no partition moves every row into one
task.  These operators instead cut the order into buckets that are a pure
function of the row (so a recomputed task sees the same bucket), number or sum
rows inside each bucket with a partitioned window, and add the total of all
earlier buckets.  The table of bucket totals has at most ``max_buckets`` rows
per partition key (2**18 rows of two longs, about 4 MB), which is the bound
that makes broadcasting it safe.  Beyond 2**34 rows buckets grow past
``rows_per_bucket``; a bucket is sorted by one task, spilling as needed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewise.session import scratch_path

_BUCKET = "__lw_bucket"
_KEY = "__lw_key"
_VALUE = "__lw_value"
_LOCAL = "__lw_local"
_TOTAL = "__lw_total"
_OFFSET = "__lw_offset"

DEFAULT_ROWS_PER_BUCKET = 1 << 16
DEFAULT_MAX_BUCKETS = 1 << 18
#: Buckets at most that one level of sampled edges makes (strings and other keys that are no numbers); strings have two.
MAX_SAMPLED_BUCKETS = 512
#: Characters at most of a string edge: 2**18 edges are at most 32 Mi characters.
EDGE_CHARS = 128


def _names(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def _key_stats(df: DataFrame, order_by: str) -> tuple:
    """min, max and non-null count of the key in one aggregate (answered from
    parquet footers when the scan supports aggregate pushdown)."""
    row = df.agg(F.min(order_by).alias("lo"), F.max(order_by).alias("hi"),
                 F.count(order_by).alias("n"), F.count(F.lit(1)).alias("n_all")).first()
    return row["lo"], row["hi"], row["n"], row["n_all"]


def add_range_bucket(df: DataFrame, order_by: str, *, out: str = _BUCKET,
                     rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
                     max_buckets: int = DEFAULT_MAX_BUCKETS, stats: tuple | None = None) -> DataFrame:
    """Bucket an integer order key into equal-width key ranges.

    With a unique key of density ``d`` (rows per key value) a bucket holds at
    most ``width`` rows, about ``rows_per_bucket / d``; there are never more
    than ``max_buckets`` buckets.
    """
    lo, hi, n, _ = stats or _key_stats(df, order_by)
    if lo is None:
        return df.withColumn(out, F.lit(0).cast("long"))
    n_buckets = max(1, min(max_buckets, math.ceil(n / rows_per_bucket)))
    width = max(1, math.ceil((hi - lo + 1) / n_buckets))
    # Integer division keeps exactness for keys beyond 2**53.
    shifted = df.withColumn(out, F.col(order_by).cast("long") - F.lit(int(lo)))
    # A null key sorts first, so it gets its own first bucket (-1) and is kept.
    return shifted.withColumn(out, F.coalesce(F.expr(f"`{out}` div {int(width)}"), F.lit(-1).cast("long")))


def add_quantile_bucket(df: DataFrame, order_by: str, *, out: str = _BUCKET,
                        rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
                        max_buckets: int = DEFAULT_MAX_BUCKETS,
                        relative_error: float | None = None) -> DataFrame:
    """Bucket a numeric order key by approximate quantile edges.

    For keys whose values cluster (timestamps in bursts, sparse ids) equal-width
    ranges would be unbalanced; quantile edges keep buckets near equal in rows.
    The error is a quarter of a bucket unless given.
    """
    from pyspark.ml.feature import Bucketizer

    n = df.select(order_by).where(F.col(order_by).isNotNull()).count()
    n_buckets = max(1, min(max_buckets, math.ceil(n / rows_per_bucket)))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    keyed = df.withColumn("__lw_key_d", F.col(order_by).cast("double"))
    edges = sorted(set(keyed.approxQuantile("__lw_key_d", probs, relative_error or max(1e-6, 0.25 / n_buckets)))) if probs else []
    if not edges:
        return df.withColumn(out, F.when(F.col(order_by).isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long"))
    splits = [-math.inf] + edges + [math.inf]
    bucketed = Bucketizer(splits=splits, inputCol="__lw_key_d", outputCol=out,
                          handleInvalid="keep").transform(keyed)
    bucket = F.when(F.col(order_by).isNull(), F.lit(-1)).otherwise(F.col(out)).cast("long")
    return bucketed.withColumn(out, bucket).drop("__lw_key_d")


def _integral(df: DataFrame, key: str):
    """An integer expression in the key's order (integers, dates and timestamps), or None."""
    kind = df.schema[key].dataType.typeName()
    if kind in ("long", "integer", "short", "byte"):
        return F.col(key).cast("long")
    if kind == "date":
        return F.unix_date(key).cast("long")
    if kind == "timestamp":
        return F.unix_micros(key)
    if kind == "timestamp_ntz":
        return F.unix_micros(F.to_utc_timestamp(F.col(key).cast("string").cast("timestamp"), F.current_timezone()))
    return None


def _hash_share(key: str, share: float):
    """Rows drawn by hash, about ``share`` of them."""
    return F.pmod(F.xxhash64(key, F.monotonically_increasing_id()), F.lit(1 << 30)) < max(1, int(min(1.0, share) * (1 << 30)))


def _sampled_bucket(df: DataFrame, key: str, out: str, rows_per_bucket: int,
                    max_buckets: int = DEFAULT_MAX_BUCKETS) -> DataFrame:
    """Bucket any other sortable key by edges from a bounded hash sample of its values.

    A string key of more rows than one level of edges can cut gets a second
    level inside each of these buckets.
    """
    n = df.count()
    n_buckets = max(1, min(MAX_SAMPLED_BUCKETS, math.ceil(n / rows_per_bucket)))
    text = df.schema[key].dataType.typeName() == "string"
    edge = F.substring(key, 1, EDGE_CHARS) if text else F.col(key)  # any string can be an edge, so a cut one too
    sample = (df.select(key).where(F.col(key).isNotNull()).where(_hash_share(key, 64 * n_buckets / max(1, n)))
              .select(edge.alias(key)).orderBy(key).limit(128 * n_buckets).collect())
    values = [r[0] for r in sample]
    edges = sorted({values[len(values) * k // n_buckets] for k in range(1, n_buckets)},
                   key=lambda e: e.encode() if text else e) if values else []

    def pick(lo: int, hi: int):
        # A balanced tree of comparisons: bucket k holds edges[k-1] <= key < edges[k].
        if lo == hi:
            return F.lit(lo).cast("long")
        mid = (lo + hi) // 2
        return F.when(F.col(key) < F.lit(edges[mid]), pick(lo, mid)).otherwise(pick(mid + 1, hi))

    first = df.withColumn(out, F.when(F.col(key).isNull(), F.lit(-1).cast("long")).otherwise(pick(0, len(edges))))
    inner = min(MAX_SAMPLED_BUCKETS, max_buckets // max(1, len(edges) + 1), math.ceil(n / (rows_per_bucket * (len(edges) + 1))))
    return _inner_bucket(first, key, out, inner, 32 * inner * (len(edges) + 1) / max(1, n)) if text and inner > 1 else first


def _inner_bucket(df: DataFrame, key: str, out: str, inner: int, share: float) -> DataFrame:
    """Cut each bucket of a string key into up to ``inner`` by edges of its own.

    The edges are at even places among a bucket's distinct sampled keys (a key
    that holds a third of the rows counts once), written once so that every
    reader sees the same ones, and broadcast: at most ``max_buckets`` edges of
    ``EDGE_CHARS`` characters.
    """
    kept = (df.where(F.col(key).isNotNull()).where(_hash_share(key, share))
            .select(F.col(out).alias("__lw_b"), F.substring(key, 1, EDGE_CHARS).alias("__lw_e")).distinct())
    listed = kept.groupBy("__lw_b").agg(F.array_sort(F.collect_list("__lw_e")).alias("__lw_all"))
    place = f"int(size(__lw_all) * cast(k as bigint) div {inner})"
    cut = f"array_distinct(transform(sequence(1, {inner - 1}), k -> get(__lw_all, {place})))"
    path = scratch_path(df.sparkSession, "edges")
    listed.select("__lw_b", F.expr(cut).alias("__lw_edges")).write.parquet(path)
    edges = df.sparkSession.read.schema("__lw_b long, __lw_edges array<string>").parquet(path)
    found = (df.join(F.broadcast(edges), F.col(out) == F.col("__lw_b"), "left")
             .withColumn("__lw_at", F.lit(0)))
    # Binary search, one projection a step: how many edges are not above the key.
    step = 1 << (inner - 1).bit_length()
    while step > 1:
        step //= 2
        reached = F.coalesce(F.expr(f"get(__lw_edges, __lw_at + {step - 1})") <= F.col(key), F.lit(False))
        found = found.withColumn("__lw_at", F.col("__lw_at") + F.when(reached, step).otherwise(0))
    whole = F.when(F.col(out) < 0, F.col(out)).otherwise(F.col(out) * inner + F.col("__lw_at"))
    return found.withColumn(out, whole).drop("__lw_b", "__lw_edges", "__lw_at")


def _bucketed(df: DataFrame, order_by: list[str], bucket: str | Sequence[str] | None,
              rows_per_bucket: int, max_buckets: int) -> tuple[DataFrame, list[str], bool]:
    """Return (frame with bucket columns, bucket column names, bucket added here).

    Only the first order column is bucketed; rows that tie on it share a bucket.
    """
    if bucket is not None:
        return df, _names(bucket), False
    key = order_by[0]
    kind = df.schema[key].dataType.typeName()
    whole = _integral(df, key)
    if whole is not None:
        framed = df.withColumn(_KEY, whole)
        lo, hi, n, _ = stats = _key_stats(framed, _KEY)
        # Equal-width ranges are balanced only for a dense key: with at least one
        # row per two key values a range bucket holds <= 2 x rows_per_bucket rows.
        # A sparse or outlier-stretched key gets quantile edges instead.
        dense = lo is None or 2 * n >= hi - lo + 1
        add = add_range_bucket if dense else add_quantile_bucket
        extra = {"stats": stats} if dense else {}
        out = add(framed, _KEY, rows_per_bucket=rows_per_bucket, max_buckets=max_buckets, **extra)
        return out.drop(_KEY), [_BUCKET], True
    if kind in ("double", "float") or kind.startswith("decimal"):
        return add_quantile_bucket(df, key, rows_per_bucket=rows_per_bucket, max_buckets=max_buckets), [_BUCKET], True
    return _sampled_bucket(df, key, _BUCKET, rows_per_bucket, max_buckets), [_BUCKET], True


def _prefix(df: DataFrame, local_expr, bucket_total_expr, order_by, partition_by, bucket,
            rows_per_bucket, max_buckets):
    """Shared skeleton: local window result + total of earlier buckets (null before the first value)."""
    order_cols = _names(order_by)
    part_cols = _names(partition_by)
    framed, bucket_cols, added = _bucketed(df, order_cols, bucket, rows_per_bucket, max_buckets)
    w_local = (Window.partitionBy(*part_cols, *bucket_cols).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = framed.withColumn(_LOCAL, local_expr(w_local))
    # Bucket totals: partial aggregation before the shuffle, one row per bucket.
    keys = [*part_cols, *bucket_cols]
    totals = framed.groupBy(*keys).agg(bucket_total_expr.alias(_TOTAL))
    w_off = (Window.partitionBy(*part_cols).orderBy(*bucket_cols)
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*[F.col(k).alias(f"__lw_o{i}") for i, k in enumerate(keys)],
                            F.sum(_TOTAL).over(w_off).alias(_OFFSET))
    if not part_cols and added:
        # At most max_buckets rows: a proven bound, so broadcasting is safe.
        offsets = F.broadcast(offsets)
    # Null-safe: a null partition or bucket is a key like any other.
    same = [F.col(k).eqNullSafe(F.col(f"__lw_o{i}")) for i, k in enumerate(keys)]
    joined = local.join(offsets, on=same, how="inner").drop(*[f"__lw_o{i}" for i in range(len(keys))])
    return joined, bucket_cols if added else []


def running_sum(df: DataFrame, value: Column | str, order_by: str | Sequence[str], *,
                out: str = "running_sum", partition_by: str | Sequence[str] | None = None,
                bucket: str | Sequence[str] | None = None,
                rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
                max_buckets: int = DEFAULT_MAX_BUCKETS) -> DataFrame:
    """Running sum of ``value`` in ``order_by`` order, current row included.

    ``order_by`` must be unique (within ``partition_by``); ties have no defined
    running sum.  ``bucket`` may name columns that are non-decreasing along the
    order (for example a file and its split start); otherwise buckets are
    derived from the first order column.  Null values add nothing, as in SQL: the
    sum is null until the first value that is not null.
    """
    v = F.col(value) if isinstance(value, str) else value
    framed = df.withColumn(_VALUE, v)
    joined, extra = _prefix(
        framed,
        lambda w: F.sum(_VALUE).over(w),
        F.sum(_VALUE),
        order_by, partition_by, bucket, rows_per_bucket, max_buckets,
    )
    zero = F.lit(0)
    result = joined.withColumn(out, F.when(F.col(_LOCAL).isNotNull() | F.col(_OFFSET).isNotNull(),
                                           F.coalesce(_LOCAL, zero) + F.coalesce(_OFFSET, zero)))
    return result.drop(_VALUE, _LOCAL, _OFFSET, *extra)


def row_number(df: DataFrame, order_by: str | Sequence[str], *, out: str = "row_number",
               partition_by: str | Sequence[str] | None = None,
               bucket: str | Sequence[str] | None = None,
               rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
               max_buckets: int = DEFAULT_MAX_BUCKETS) -> DataFrame:
    """1-based row number along a unique order, without a single-task window."""
    joined, extra = _prefix(
        df,
        lambda w: F.row_number().over(w),
        F.count(F.lit(1)),
        order_by, partition_by, bucket, rows_per_bucket, max_buckets,
    )
    result = joined.withColumn(out, (F.col(_LOCAL) + F.coalesce(F.col(_OFFSET), F.lit(0))).cast("long"))
    return result.drop(_LOCAL, _OFFSET, *extra)


def boundary_groups(df: DataFrame, is_boundary: Column, order_by: str | Sequence[str], *,
                    out: str = "group_id", flag_out: str | None = None,
                    partition_by: str | Sequence[str] | None = None,
                    bucket: str | Sequence[str] | None = None,
                    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
                    max_buckets: int = DEFAULT_MAX_BUCKETS) -> DataFrame:
    """Group id = 1 + number of boundary rows up to and including this row.

    A boundary row opens the group it belongs to; the rows before the first
    boundary form group 1.  A null predicate counts as "not a boundary".  Two
    boundaries in a row leave a group that holds only the boundary row.
    """
    flag = F.when(is_boundary, F.lit(1)).otherwise(F.lit(0))
    framed = df.withColumn(flag_out or "__lw_flag", flag)
    summed = running_sum(framed, F.col(flag_out or "__lw_flag"), order_by, out=out,
                         partition_by=partition_by, bucket=bucket,
                         rows_per_bucket=rows_per_bucket, max_buckets=max_buckets)
    summed = summed.withColumn(out, (F.col(out) + F.lit(1)).cast("long"))
    return summed if flag_out else summed.drop("__lw_flag")


def batch_rows(df: DataFrame, k: int, order_by: str | Sequence[str], *, out: str = "batch_id",
               row_out: str | None = None, partition_by: str | Sequence[str] | None = None,
               bucket: str | Sequence[str] | None = None,
               rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
               max_buckets: int = DEFAULT_MAX_BUCKETS) -> DataFrame:
    """Every ``k`` consecutive rows share a batch id 1, 2, ...; the last may be short.

    Same value as ``ceil(row_number / k)``, computed in integers.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    rn = row_out or "__lw_rn"
    numbered = row_number(df, order_by, out=rn, partition_by=partition_by, bucket=bucket,
                          rows_per_bucket=rows_per_bucket, max_buckets=max_buckets)
    numbered = numbered.withColumn(out, F.expr(f"(`{rn}` - 1) div {int(k)} + 1"))
    return numbered if row_out else numbered.drop(rn)
