"""Long repeats between documents: blocks of aligned windows, refined until each is settled.

Shared by the two repeat operators, which differ in their units (bytes, words)
and in how they choose anchors.  A *window* is ``width`` consecutive units.  Each
window has an anchor inside it that depends on the window's own content only, so
equal windows have equal anchors at equal offsets.  Consecutive windows with the
same anchor are a *run*.  For a run,

* the core is what all windows with that anchor have in common: runs whose core
  occurs once hold no repeated window and are dropped;
* the whole context (first unit of the first to last unit of the last window):
  where it occurs again, all windows of the run are repeated.

What neither settles is refined: smaller cells of windows, aligned at the anchor,
with their own core and context, down to single windows.  Each level compares
hash counts only, with partial aggregates, so a passage that a third of all
documents share costs one row per task and never brings its documents together.

Rows are told apart by document id and a tag, the 64-bit hash of the text, so repeated
or null ids with different texts do not mix.  A null id counts as larger than all others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewise.llm import packed
from linewise.llm.tables import stored
from linewise.llm.text_arrays import mix, slices

#: Stands for a null document id (the largest long).
NO_ID = (1 << 63) - 1
#: Rows at most in the broadcast that lets documents without spans skip a shuffle.
NEAR = 1 << 20
#: Runs of a block: at 40 bytes each, some 40 MB with the copies made of them.
BLOCK_RUNS = 1 << 18

RUN = "core long, context long, doc long, tag long, lo long, n int, back int"
_DTYPES = ("u4", "u4", "u2", "i8", "i8", "u4", "u2", "u2", "u1")
_LOW32 = np.uint64(0xFFFFFFFF)


def span_hash(sums: np.ndarray, inverse: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hashes of the spans [lo, hi) from running polynomial sums."""
    return mix((sums[hi] - sums[lo]) * inverse[lo] + (hi - lo).astype(np.uint64))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """doc and tag of a row."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(F.col(text_col)).alias("tag")]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, tag, text of every row."""
    return docs.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))


def _entries(batches, runs_of: Callable, buckets: int):
    """Packed runs; a core that several runs of a block share is known to be repeated.

    A block is a few MB of text, so memory does not grow with an Arrow batch.
    Known runs travel to buckets chosen by document, all but one of each core,
    so a very common core puts one entry per block into its own bucket.
    """
    parts, held = [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            row, lo, n, back, core, context = runs_of(part.column("text"))
            doc = part.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)
            tag = part.column("tag").to_numpy(zero_copy_only=False).astype(np.int64)
            parts.append((core, context, doc[row], tag[row], lo.astype(np.uint32), n.astype(np.uint16), back.astype(np.uint16)))
            held += len(core)
            if held >= BLOCK_RUNS:
                yield _block(parts, buckets)
                parts, held = [], 0
    if held:
        yield _block(parts, buckets)


def _block(parts: list[tuple], buckets: int) -> pa.RecordBatch:
    core, context, doc, tag, lo, n, back = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(core, kind="stable")
    ordered = core[order]
    same = np.zeros(len(core), bool)
    same[1:] = ordered[1:] == ordered[:-1]
    known = np.zeros(len(core), bool)
    known[order] = same | np.append(same[1:], False)
    stand_in = np.zeros(len(core), bool)
    stand_in[order] = ~same
    bucket = (core >> np.uint64(32)) % np.uint64(buckets)
    away = known & ~stand_in
    spread = mix(doc.astype(np.uint64) ^ lo.astype(np.uint64)) % np.uint64(buckets)
    return packed.to_batch(packed.blocks(np.where(away, spread, bucket).astype(np.int32), [
        (core & _LOW32).astype(np.uint32), (context & _LOW32).astype(np.uint32),
        (context >> np.uint64(48)).astype(np.uint16), doc, tag, lo, n, back, (known + 2 * away).astype(np.uint8)]))


def _kept(table: pa.Table) -> pa.Table:
    """The runs of a bucket whose core is known to be, or found here, repeated."""
    core, c_lo, c_hi, doc, tag, lo, n, back, known = packed.merged(table.column("block").to_pylist(), _DTYPES)
    own = known < 2
    keep = known > 0
    at = np.flatnonzero(own)
    order = at[np.argsort(core[at], kind="stable")]
    same = np.zeros(len(order), bool)
    if len(order):
        same[1:] = core[order][1:] == core[order][:-1]
        keep[order] |= same | np.append(same[1:], False)
    pick = lambda x, kind: pa.array(x[keep].astype(kind))
    context = (c_hi.astype(np.uint64) << np.uint64(32) | c_lo.astype(np.uint64)).view(np.int64)
    return pa.table([pick(core, np.int64), pick(context, np.int64), pick(doc, np.int64), pick(tag, np.int64),
                     pick(lo, np.int64), pick(n, np.int32), pick(back, np.int32)],
                    names=["core", "context", "doc", "tag", "lo", "n", "back"])


def shared_runs(rows: DataFrame, runs_of: Callable, buckets: int) -> DataFrame:
    entries = rows.mapInArrow(partial(_entries, runs_of=runs_of, buckets=buckets), packed.SCHEMA)
    return stored(entries.groupBy("bucket").applyInArrow(_kept, RUN), "runs")


def settle(level: DataFrame, earlier: bool) -> tuple[DataFrame, DataFrame]:
    """(rows all of whose windows are repeated, rows to refine) of one level.

    ``earlier``: repeated means that the windows also start in a document with a
    smaller id; otherwise, that they also start anywhere else.
    """
    place = F.struct("doc", "tag", "lo")
    seen = level.groupBy("core", "context").agg(F.count(F.lit(1)).alias("c"), F.min("doc").alias("least"),
                                                F.min(place).alias("first"))
    told = level.join(seen, ["core", "context"])
    full = told.where("doc > least" if earlier else "c > 1").select("doc", "tag", "lo", "n")
    several = (seen.groupBy("core").agg(F.min("context").alias("x"), F.max("context").alias("y"),
                                        F.min("least").alias("x_doc"), F.max("least").alias("y_doc"))
               .where("x != y and x_doc != y_doc" if earlier else "x != y").select("core"))
    left = told.where(F.col("doc") == F.col("least") if earlier else place == F.col("first"))
    return full, left.join(several, "core").select("doc", "tag", "lo", "n", "back")


def _near(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys.select(F.pmod(F.xxhash64("doc", "tag"), F.lit(NEAR)).alias("near")).distinct())


def with_spans(rows: DataFrame, spans: DataFrame, columns: Sequence[str], *, only: bool) -> DataFrame:
    """Rows with the list ``spans`` of their document (of those that have any if ``only``).

    A broadcast of at most 2^20 numbers lets most documents without spans skip
    the join's shuffle; the join itself decides.
    """
    # Repeated rows have equal spans, once each: a set, so that the list does not grow with the repeats.
    listed = spans.groupBy("doc", "tag").agg(F.collect_set(F.struct(*columns)).alias("spans"))
    near = _near(spans)
    key = F.pmod(F.xxhash64("doc", "tag"), F.lit(NEAR)) == F.col("near")
    joined = rows.join(near, key, "left_semi").join(listed, ["doc", "tag"], "inner" if only else "left")
    if only:
        return joined.select(*rows.columns, "spans")
    rest = rows.join(near, key, "left_anti").withColumn("spans", F.lit(None).cast(listed.schema["spans"].dataType))
    return joined.select(*rows.columns, "spans").unionByName(rest)


def _refined(batches, cells_of: Callable):
    for batch in batches:
        for part in slices(batch, "text", 500):
            out = [[] for _ in range(7)]
            texts = part.column("text").cast(pa.binary()).to_pylist()
            for doc, tag, text, spans in zip(*(part.column(c).to_pylist() for c in ("doc", "tag")), texts,
                                             part.column("spans").to_pylist()):
                lo = np.array([s["lo"] for s in spans], np.int64)
                n = np.array([s["n"] for s in spans], np.int64)
                back = np.array([s["back"] for s in spans], np.int64)
                core, context, c_lo, c_n, c_back = cells_of(text, lo, n, back)
                for held, col in zip(out, (core, context, np.full(len(core), doc), np.full(len(core), tag), c_lo, c_n, c_back)):
                    held.append(col)
            cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
            kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int32, np.int32)
            arrays = [pa.array(c.astype(k).view(np.int64) if k is np.uint64 else c.astype(k)) for c, k in zip(cols, kinds)]
            yield pa.record_batch(arrays, names=["core", "context", "doc", "tag", "lo", "n", "back"])


def refine(rows: DataFrame, left: DataFrame, cells_of: Callable) -> DataFrame:
    """The next level: the cells of the runs that are left."""
    chosen = with_spans(rows, left, ["lo", "n", "back"], only=True)
    return stored(chosen.mapInArrow(partial(_refined, cells_of=cells_of), RUN), "cells")


def repeated_starts(rows: DataFrame, runs_of: Callable, levels: Sequence[Callable], *, earlier: bool,
                    bytes_per_bucket: int) -> DataFrame:
    """doc, tag, lo, n: ranges of starts of the repeated windows."""
    level = shared_runs(rows, runs_of, packed.bucket_count(rows, "text", bytes_per_bucket))
    found, left = settle(level, earlier)
    for cells_of in levels:
        full, left = settle(level := refine(rows, stored(left, "left"), cells_of), earlier)
        found = found.unionByName(full)
    return stored(found, "starts")


def covered(lo: np.ndarray, n: np.ndarray, width: int, length: int) -> np.ndarray:
    """Mask of the units that windows starting in the ranges [lo, lo + n) cover."""
    delta = np.zeros(length + 1, np.int32)
    np.add.at(delta, lo, 1)
    np.add.at(delta, np.minimum(lo + n - 1 + width, length), -1)
    return np.cumsum(delta[:-1]) > 0
