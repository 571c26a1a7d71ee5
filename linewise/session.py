"""Session helpers: a local session for tests/bench and the shared work folder.

The library never creates its own session inside an operator; callers pass one
in.  ``local_session`` only exists for tests, the benchmark and the examples.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "linewise") -> SparkSession:
    """A local-mode session configured like a small cluster would be.

    AQE stays on so partition coalescing and skew-join splitting happen at
    runtime; the UI is off (no server).
    """
    n = shuffle_partitions or (8 if cores == "*" else max(2, int(cores) * 2))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Parquet through DataSource V2 so MIN/MAX/COUNT (bucket sizing in
        # operators.sequence) are answered from footers, not a column scan.
        .config("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
        .config("spark.sql.parquet.aggregatePushdown", "true")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can see, taken from ``spark.checkpoint.dir``.

    On a cluster this setting must name a shared file system folder: without it
    this raises, since executors do not see each other's local folders.  With a
    local master (tests) a fresh local folder is made and registered, so a later
    call and ``DataFrame.checkpoint()`` use the same place.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        master = sc.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="linewise-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared folder (not created yet)."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")
