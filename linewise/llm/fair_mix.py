"""Operator 10: mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled (by a hash of id and text) and may be passed
through ``passes`` times.  A document's copy has the virtual finish time

    (words of the source's earlier copies + its own words) / target of its source,

so at time 1 every source has given its target.  Copies that begin before time 1
are range-sorted by finish time over all sources, and the order is truncated at
the total budget.

Prefix sums never bring a source into one task: a source is cut into buckets by
hash range (about ``rows_per_bucket`` rows each), bucket totals are summed along
the source, and rows are summed inside buckets; the time axis likewise.  The one
thing that reaches the driver is the cut: one row.

Edge cases: a null text has size 0.  Null sources are a source, the last one.  A
null doc_id is shuffled by its text.  Equal rows finish at the same time and are
taken together.  Documents of size 0 take nothing.  Extra columns are ignored;
empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linewise.llm.tables import stored

WORD = "[^\\x20\\x09-\\x0D]+"


def words_in(text_col: str):
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(id_col: str, text_col: str):
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit(""))))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, passes: int) -> DataFrame:
    """source, source_size, n, target of each source (one row per source).

    Targets are ``min(passes * size, level * weight)`` with one level for all:
    what a full source cannot take goes to the others by weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1  # one row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    full = F.col("source_size") * F.lit(passes)
    everywhere = Window.partitionBy()
    before = Window.orderBy(full / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(share) * F.sum("source_size").over(everywhere) - F.coalesce(F.sum(full).over(before), F.lit(0))
    open_weight = F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    leveled = per.withColumn("weight", weight).withColumn("level", left / open_weight)
    leveled = leveled.withColumn("level", F.max("level").over(everywhere))
    return leveled.select("source", "source_size", "n",
                          F.least(full.cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _bucket(buckets):
    """The bucket of a row by its shuffle key, in the order of the key."""
    part = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return F.floor(part * buckets).cast("long")


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.5, passes: int = 2,
                rows_per_bucket: int = 20_000) -> DataFrame:
    """doc_id, size, source_size, target, taken, and ``copies`` and ``key`` (the shuffle key) of every row."""
    sizes = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               words_in(text_col).alias("size"), shuffle_key(id_col, text_col).alias("key")), "sizes")
    targets = stored(source_targets(sizes, weights, share, passes), "targets")
    rows = sizes.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "r.*", "t.source_size", "t.target", _bucket(F.ceil(F.col("n") / rows_per_bucket)).alias("bucket"))

    totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("source").alias("s"), F.col("bucket").alias("b"),
                          F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("key")  # equal keys are peers
    summed = (rows.withColumn("inside", F.sum("size").over(inside))
              .join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
              .withColumn("through", F.col("base") + F.col("inside")))
    summed = stored(summed.select("doc_id", "source", "size", "key", "source_size", "target", "through"), "queued")

    def finish(k):
        return (F.lit(k) * F.col("source_size") + F.col("through")) / F.col("target")

    copies = summed.where("target > 0 and size > 0").select(
        "size", "key", F.explode(F.array(*[F.struct(finish(k).alias("finish"),
                                                    (finish(k) - F.col("size") / F.col("target")).alias("begin"))
                                           for k in range(passes)])).alias("c")).select("size", "key", "c.finish", "c.begin")
    copies = copies.where("begin < 1")
    row = sizes.agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("n")).first()
    budget = share * (row["total"] or 0)
    steps = max(1, -(-row["n"] * passes // rows_per_bucket))
    timed = copies.withColumn("step", F.least(F.floor(F.col("finish") * steps), F.lit(2 * steps)).cast("long"))
    per_step = timed.groupBy("step").agg(F.sum("size").alias("total"))
    through = F.sum("total").over(Window.orderBy("step"))  # one row per step of the time axis
    crossing = (per_step.withColumn("through", through).where(F.col("through") > budget)
                .orderBy("step").select("step", (F.col("through") - F.col("total")).alias("base")).first())
    accepted = [F.lit(0)] * passes
    if crossing is None:  # nothing is beyond the budget
        accepted = [F.when(finish(k) - F.col("size") / F.col("target") < 1, 1).otherwise(0) for k in range(passes)]
    else:
        # Inside the one step (about rows_per_bucket rows) that crosses the budget: the last copy that fits.
        ordered = Window.orderBy("finish", "key")
        last = (timed.where(F.col("step") == crossing["step"])
                .withColumn("through", F.lit(crossing["base"]) + F.sum("size").over(ordered))
                .where(F.col("through") <= budget).orderBy(F.desc("finish"), F.desc("key")).select("finish", "key").first())
        for k in range(passes):
            f = finish(k)
            begins = f - F.col("size") / F.col("target") < 1
            whole = F.least(F.floor(f * steps), F.lit(2 * steps)) < crossing["step"]
            inside_step = F.lit(False) if last is None else (
                (F.least(F.floor(f * steps), F.lit(2 * steps)) == crossing["step"])
                & ((f < last["finish"]) | ((f == last["finish"]) & (F.col("key") <= last["key"]))))
            accepted[k] = F.when(begins & (whole | inside_step), 1).otherwise(0)
    n = sum(accepted[1:], accepted[0])
    n = F.when((F.col("target") > 0) & (F.col("size") > 0), n).otherwise(0)
    return summed.select("doc_id", "size", "source_size", "target", (n * F.col("size")).cast("long").alias("taken"),
                         n.cast("int").alias("copies"), "key")


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that the mix takes, with all their columns and size, source_size, target, taken, copies.

    A column of the documents keeps its name and values; of the five, one whose
    name the documents have already is called ``mix_`` and its name.
    """
    # The same id and text have the same key and the same decision.
    taken = mix_sources(docs, id_col=id_col, text_col=text_col, **options).where("taken > 0").dropDuplicates(["key"])
    names = {}
    for c in ("size", "source_size", "target", "taken", "copies"):
        names[c] = c
        while names[c].lower() in {x.lower() for x in docs.columns}:
            names[c] = f"mix_{names[c]}"
    chosen = taken.select(F.col("key").alias("__mix_key"), *[F.col(c).alias(f"__mix_{c}") for c in names])
    return (docs.join(chosen, shuffle_key(id_col, text_col) == F.col("__mix_key"))
            .select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"__mix_{c}").alias(names[c]) for c in names]))
