"""Event-time windows over a stream of files, and boundary groups that go on from batch to batch.

Windows are Spark's own watermarked state: a window leaves the state, and is
written once, when the watermark (the latest event time of the batches before,
less the lateness) has passed its end.  So a replay in any number of pieces
gives the closed windows of the batch answer, as long as no row comes later than
the lateness allows; rows that do are dropped, and counted.

Boundary groups carry one row per key from batch to batch: the groups opened so
far and the last order value.  Inside a batch the work is that of
``boundary_groups``, so a key that holds most of a batch is cut into buckets and
no key's rows are brought to one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewise.operators.sequence import boundary_groups
from linewise.session import scratch_path
from linewise.streaming.files import _await, file_stream

#: Batches of a run whose dropped rows are counted (Spark keeps so many progress records).
_RECORDS = 10_000
_SEEN = "__lw_seen"
_LAST = "__lw_last"


def instant(df: DataFrame, col: str) -> Column:
    """A timestamp of ``col`` that windows can use: one without a time zone is read as UTC, in any session."""
    if df.schema[col].dataType.typeName() != "timestamp_ntz":
        return F.col(col).cast("timestamp")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col(col)))


def event_windows(df: DataFrame, time_col: str, aggs: Mapping[str, Column], *, size: str | None = None,
                  slide: str | None = None, gap: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """``aggs`` per key and window: tumbling (``size``), sliding (``size``, ``slide``) or session (``gap``).

    The same call on a table and on a stream (``run_windows``).  Windows start at
    multiples of their size or slide since 1970 in UTC; a session ends ``gap``
    after its last row, and a row at that very time still joins it.  Rows with a
    null time are in no window; a null key is a key.  A stream's sessions need a key.
    """
    if (size is None) == (gap is None) or (slide and not size):
        raise ValueError("give size (and slide), or gap")
    window = F.session_window(time_col, gap) if gap else F.window(time_col, size, slide)
    timed = df.where(F.col(time_col).isNotNull())
    start, end = F.col("__window.start"), F.col("__window.end")
    values = [c.alias(n) for n, c in aggs.items()]
    if gap:
        # Not the group's own bounds: a filter on these goes below the merging of sessions and cuts them.
        start, end = F.col("__first"), F.col("__last") + F.expr(f"interval {gap}")
        values += [F.min(time_col).alias("__first"), F.max(time_col).alias("__last")]
    out = timed.groupBy(window.alias("__window"), *keys).agg(*values)
    return out.select(start.alias("window_start"), end.alias("window_end"), *keys, *aggs)


def run_windows(spark: SparkSession, source_dir: str, transform: Callable[[DataFrame], DataFrame], time_col: str,
                aggs: Mapping[str, Column], *, name: str, lateness: str, size: str | None = None,
                slide: str | None = None, gap: str | None = None, keys: Sequence[str] = (),
                file_glob: str = "*.parquet", out_path: str | None = None, max_files_per_trigger: int = 1000,
                state_partitions: int | None = None, timeout_s: float | None = None) -> tuple[str, int]:
    """The closed windows of a file stream, appended to a parquet folder: (folder, late rows dropped).

    ``transform`` gives the stream's columns, ``time_col`` among them.  A call
    with the same ``out_path`` goes on where the last one, ended or failed, stopped.
    Late rows are those of this call's last 10,000 batches, as Spark counts them: after
    each task has summed its rows per window and key.  ``state_partitions`` is
    pinned by Spark when the checkpoint is new.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(_RECORDS))
    if state_partitions:
        session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    stream = transform(file_stream(session, source_dir, file_glob=file_glob,
                                   max_files_per_trigger=max_files_per_trigger))
    windows = event_windows(stream.withWatermark(time_col, lateness), time_col, aggs,
                            size=size, slide=slide, gap=gap, keys=keys)
    out = out_path or scratch_path(spark, f"{name}-windows")
    query = (windows.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", out + "-checkpoint")
             .outputMode("append").trigger(availableNow=True).start())
    _await(query, name, timeout_s)
    late = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    return out, late


def run_boundary_groups(spark: SparkSession, source_dir: str, transform: Callable[[DataFrame], DataFrame],
                        is_boundary: Column, order_by: str, *, name: str, partition_by: str | Sequence[str] = (),
                        out: str = "group_id", file_glob: str = "*.parquet", out_path: str | None = None,
                        max_files_per_trigger: int = 1000, timeout_s: float | None = None) -> str:
    """``boundary_groups`` over a file stream: group ids go on from batch to batch; read with ``read_groups``.

    Each key's rows must come in order: a row whose order value lies before the
    last one of an earlier batch ends the run with an error, instead of a wrong
    group.  (Equal values may meet at the border; rows of a null order value may
    come in the first batch of their key only, as nulls are first.)  Every
    batch writes its rows and its carried table into folders of its own, so a batch
    that is run again after a failure writes the same folders again; a call with the
    same ``out_path`` goes on after the last batch.
    """
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    path = out_path or scratch_path(spark, f"{name}-groups")
    ks = [f"__lw_k{i}" for i in range(len(keys))]

    def state(batch: DataFrame) -> DataFrame:
        order = F.col(order_by)
        return batch.groupBy(*[F.col(k).alias(c) for k, c in zip(keys, ks)]).agg(
            F.coalesce(F.sum(F.when(is_boundary, 1).otherwise(0)), F.lit(0)).cast("long").alias(_SEEN),
            F.max(order).alias(_LAST), F.min(order).alias("__lw_least"), F.count_if(order.isNull()).alias("__lw_nulls"))

    def write_batch(batch: DataFrame, n: int) -> None:
        now = state(batch)
        earlier = batch.sparkSession.read.parquet(f"{path}/carry/batch={n - 1}") if n else state(batch.where(F.lit(False)))
        before = earlier.select(*ks, _SEEN, _LAST)
        old, new = before.alias("old"), now.alias("new")
        on = F.lit(True)
        for c in ks:
            on = on & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
        wrong = new.join(old, on).where(F.col(f"old.{_LAST}").isNotNull()
                                        & ((F.col("new.__lw_least") < F.col(f"old.{_LAST}")) | (F.col("new.__lw_nulls") > 0)))
        if n and not wrong.isEmpty():
            raise ValueError(f"stream {name}: rows of batch {n} come before rows of earlier batches")
        both = before.unionByName(now.select(*ks, _SEEN, _LAST))
        both.groupBy(*ks).agg(F.sum(_SEEN).alias(_SEEN), F.max(_LAST).alias(_LAST)) \
            .write.mode("overwrite").parquet(f"{path}/carry/batch={n}")
        rows = boundary_groups(batch, is_boundary, order_by, out=out, partition_by=keys or None)
        offset = before.select(*ks, F.col(_SEEN).alias("__lw_before"))
        if not keys:
            offset = F.broadcast(offset)  # one row
        at = F.lit(True)
        for k, c in zip(keys, ks):
            at = at & F.col(f"`{k}`").eqNullSafe(F.col(c))
        numbered = rows.join(offset, at, "left").withColumn(out, F.col(out) + F.coalesce("__lw_before", F.lit(0)))
        numbered.drop("__lw_before", *ks).write.mode("overwrite").parquet(f"{path}/rows/batch={n}")

    stream = transform(file_stream(spark, source_dir, file_glob=file_glob, max_files_per_trigger=max_files_per_trigger))
    query = (stream.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())
    _await(query, name, timeout_s)
    return path


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """All rows that ``run_boundary_groups`` wrote, with their group ids."""
    return spark.read.parquet(f"{path}/rows").drop("batch")
