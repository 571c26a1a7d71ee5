"""Intermediate tables in the shared folder, and connected components over links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linewise.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    This cuts the lineage: a lost executor costs only the tasks that read the
    files, and several readers do not compute ``df`` again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def forget(*tables: DataFrame | None) -> None:
    """Delete stored tables that nothing will read again, and let Spark clear the shuffles behind them.

    Only for tables all of whose results are stored themselves: a lost
    executor then never needs them.
    """
    spark = None
    for table in tables:
        path = getattr(table, "stored_at", None)
        if path:
            spark, table.stored_at = table.sparkSession, None
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if spark is not None:  # Spark's cleaner removes shuffle files once their plans are collected
        spark._jvm.System.gc()


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _stored_edges(edges: DataFrame, name: str) -> tuple[DataFrame, tuple[int, int]]:
    """The stored links with their number and the sum of their hashes, which the write itself observes."""
    seen = Observation()
    hashed = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    table = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), hashed.alias("s")), name)
    return table, (seen.get["n"], seen.get["s"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u").where("v != m")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame, a: str, b: str, *, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has a link; the component is its smallest node.

    Alternating large-star and small-star rounds.  Each is an aggregate (the
    smallest neighbour, partially aggregated) joined back to the links, so a
    node with very many links is split like any skewed join.  Each round is
    stored; rounds grow with the logarithm of the longest path.
    """
    edges, before = _stored_edges(
        links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
        .where("a is not null and b is not null and a != b").distinct(), "links")
    if before[0]:
        for _ in range(max_rounds):
            last = edges
            edges, after = _stored_edges(_small_star(_large_star(last)), "stars")
            forget(last)
            if after == before:
                break
            before = after
        else:
            raise RuntimeError("components did not settle")
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
