"""Structured Streaming runs of the row-local operators.

The parse / recode / rule / interval operators are plain Column expressions,
so they apply unchanged to a streaming DataFrame.  The order-sensitive
operators (``operators.sequence``) need a total order over the whole input and
stay batch-only: Spark rejects non-time windows on streams.  ``event_time`` has
boundary groups that go on from batch to batch, and event-time windows.

Runs here are incremental and restartable: progress and the file sink's log
live under a checkpoint folder in the shared folder, so a lost executor or a
restarted driver resumes from the last committed micro-batch, and the file
sink writes every batch exactly once.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewise.session import scratch_path


def file_stream(spark: SparkSession, source_dir: str, *, file_glob: str = "*.parquet",
                source_format: str = "parquet", max_files_per_trigger: int = 1000) -> DataFrame:
    """A streaming DataFrame over ``source_dir/file_glob``: files, or folders of part files."""
    # The file source takes a plain path for a folder; a pattern may name files and folders alike.
    pattern = file_glob if set(file_glob) & set("*?[{") else f"{file_glob[:-1]}[{file_glob[-1]}]"
    path = os.path.join(source_dir, pattern)
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    if source_format == "parquet":
        return reader.schema(spark.read.parquet(path).schema).parquet(path)
    if source_format == "text":
        return reader.text(path)
    raise ValueError(f"unsupported source format {source_format!r}")


def _await(query, name: str, timeout_s: float | None) -> None:
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise query.exception()


def run_to_files(spark: SparkSession, source_dir: str, transform: Callable[[DataFrame], DataFrame], *,
                 name: str, file_glob: str = "*.parquet", source_format: str = "parquet",
                 out_path: str | None = None, max_files_per_trigger: int = 1000,
                 timeout_s: float | None = None) -> str:
    """Stream the files of ``source_dir`` matching ``file_glob`` through
    ``transform`` into a parquet folder.

    ``source_format`` is ``"parquet"`` (schema taken from the files) or
    ``"text"`` (one ``value`` row per line).  Uses the ``availableNow``
    trigger: everything present is processed in micro-batches, then the query
    stops.  Returns the output folder.
    """
    stream = file_stream(spark, source_dir, file_glob=file_glob, source_format=source_format,
                         max_files_per_trigger=max_files_per_trigger)
    out = out_path or scratch_path(spark, f"{name}-out")
    query = (transform(stream).writeStream
             .format("parquet")
             .option("path", out)
             .option("checkpointLocation", out + "-checkpoint")
             .outputMode("append")
             .trigger(availableNow=True)
             .start())
    _await(query, name, timeout_s)
    return out


def run_totals(spark: SparkSession, source_dir: str, transform: Callable[[DataFrame], DataFrame],
               keys: Sequence[str], aggs: Mapping[str, Column], *, name: str, file_glob: str = "*.parquet",
               source_format: str = "parquet", out_path: str | None = None,
               max_files_per_trigger: int = 1000, state_partitions: int | None = None,
               timeout_s: float | None = None) -> str:
    """A stateful streaming aggregation: running totals per key over a file stream.

    The grouped state lives in the state store under the checkpoint, so a
    restarted query continues the totals.  Each micro-batch writes the complete
    current table into a folder of its own (``batch=<id>``; a replayed batch
    writes the same folder again), so a failure never touches the totals of
    earlier batches.  Complete mode re-emits every key each batch: meant for key
    sets of bounded size (labels, codes), not for data-sized keys.
    ``state_partitions`` sets the number of state-store partitions when the
    checkpoint is new (Spark pins it there); by default the session's shuffle
    partition count is used, and only this stream's own session is set.  Returns
    the folder; ``read_totals`` reads the latest totals from it.
    """
    session = spark.newSession()
    if state_partitions:
        session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    stream = file_stream(session, source_dir, file_glob=file_glob, source_format=source_format,
                         max_files_per_trigger=max_files_per_trigger)
    totals = transform(stream).groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    out = out_path or scratch_path(spark, f"{name}-totals")

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch_id}")

    writer = (totals.writeStream
              .outputMode("complete")
              .foreachBatch(write_batch)
              .option("checkpointLocation", out + "-checkpoint")
              .trigger(availableNow=True))
    _await(writer.start(), name, timeout_s)
    return out


def read_totals(spark: SparkSession, out: str) -> DataFrame:
    """The totals of the last batch that ``run_totals`` wrote to ``out``."""
    batches = spark.read.parquet(out)
    last = batches.agg(F.max("batch")).first()[0]
    return batches.where(F.col("batch") == last).drop("batch")
