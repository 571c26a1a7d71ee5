"""Operator 6: near-duplicate vectors by a forest of random-projection trees.

Vectors of the same label and length are compared; two link when their cosine
(double precision) is at least ``threshold``.

* Equal vectors of a label become one, with a count, so copies never meet.
* Each tree splits recursively: a node projects on a random direction and cuts at
  the median of a sample; vectors near the cut go to both sides (spill).  The
  sample (at most ``sample`` vectors, chosen by hash) fixes the cuts only; every
  vector is routed.  Trees are deep enough for leaves of about ``leaf`` vectors.
* Vectors are compared within leaves by a matrix product.  A leaf of more than
  two blocks of ``block`` vectors is compared block against block in separate
  groups, so no task holds an oversized leaf and nothing is dropped.
* A pair is counted in the first leaf that it shares (each vector carries its
  leaves), so no list of pairs is needed: a group returns for each vector its
  number of new links and the root of its local component.

Edge cases: a vector that is null, empty, zero, or holds nulls or non-finite
numbers, or whose label is null, links with nothing.  Null ids keep their rows
and do not name components.  Extra columns are ignored; empty tables give empty
results.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.tables import components, stored

_MAX_DEPTH = 20
#: Numbers at most that one step of the routing copies for each leaf.
_PIECE = 1 << 20


def direction(tree: int, depth_path: int, dim: int) -> np.ndarray:
    """The direction of a node: the same in every task."""
    return np.random.default_rng([tree, depth_path, dim]).standard_normal(dim)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_cuts(vectors: np.ndarray, trees: int, depth: int, spill: float) -> dict:
    """(tree, node) -> (low, cut, high): vectors below ``high`` go left, those above ``low`` right.

    Nodes are numbered as in a heap (root 1).  A node of fewer than 8 sampled
    vectors is not cut.
    """
    cuts, unit = {}, _unit(vectors)
    for tree in range(trees):
        level = {1: np.arange(len(unit))}
        for _ in range(depth):
            below = {}
            for node, at in level.items():
                if len(at) < 8:
                    continue
                p = unit[at] @ direction(tree, node, unit.shape[1])
                low, cut, high = np.quantile(p, [0.5 - spill, 0.5, 0.5 + spill])
                cuts[tree, node] = (float(low), float(cut), float(high))
                below[2 * node], below[2 * node + 1] = at[p <= cut], at[p > cut]
            level = below
    return cuts


def leaves_of(unit: np.ndarray, cuts: dict, tree: int) -> list[tuple[int, np.ndarray]]:
    """The leaves of a tree and the vectors that each holds."""
    out = []
    open_nodes = [(1, np.arange(len(unit)))]
    while open_nodes:
        node, at = open_nodes.pop()
        cut = cuts.get((tree, node))
        if cut is None or not len(at):
            out.append((node, at))
            continue
        p = unit[at] @ direction(tree, node, unit.shape[1])
        open_nodes += [(2 * node, at[p <= cut[2]]), (2 * node + 1, at[p > cut[0]])]
    return out


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """The items of a list column in one array, and the length of each list."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column).to_numpy(zero_copy_only=False)


def _route(batches, shared, trees: int):
    """node, tree, leaf, member's row and all leaves: one row for each leaf of a vector."""
    for batch in batches:
        widest = pc.max(pc.list_value_length(batch.column("embedding"))).as_py() or 1
        step = max(1, _PIECE // widest)
        for at in range(0, batch.num_rows, step):
            yield _routed(batch.slice(at, step), shared.value, trees)


def _routed(batch: pa.RecordBatch, forest: dict, trees: int) -> pa.RecordBatch:
    values, dims = _lists(batch.column("embedding"))
    start = np.cumsum(dims) - dims
    names = [f"{name}/{dim}" for name, dim in zip(batch.column("label").to_pylist(), dims.tolist())]
    groups = {}
    for i, name in enumerate(names):
        groups.setdefault(name, []).append(i)
    member, code = [], []
    for name, found in groups.items():
        at = np.array(found)
        unit = _unit(values[start[at][:, None] + np.arange(dims[at[0]])])
        for tree in range(trees):
            for leaf, inside in leaves_of(unit, forest.get(name, {}), tree):
                member.append(at[inside])
                code.append(np.full(len(inside), tree << 32 | leaf, np.int64))
    member, code = np.concatenate(member), np.concatenate(code)
    order = np.lexsort((code, member))
    member, code = member[order], code[order]
    ends = np.cumsum(np.bincount(member, minlength=batch.num_rows))
    leaves = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(code))
    take = pa.array(member)
    return pa.record_batch([batch.column("node").take(take), pa.array(names).take(take),
                            pa.array(code >> 32), pa.array(code & 0xFFFFFFFF), batch.column("times").take(take),
                            batch.column("embedding").take(take), leaves.take(take)],
                           names=["node", "label", "tree", "leaf", "times", "embedding", "leaves"])


def _first_shared(codes: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray, here: int) -> np.ndarray:
    """Whether ``here`` is the smallest leaf code that the pairs share."""
    width = int(lengths.max())
    table = np.full((len(lengths), width), -1, np.int64)
    table[np.arange(width) < lengths[:, None]] = codes
    out = np.ones(len(a), bool)
    for at in range(0, len(a), 20_000):
        x, y = table[a[at:at + 20_000]], table[b[at:at + 20_000]]
        before = (x < here) & (x >= 0)
        for k in range(width):
            out[at:at + 20_000] &= ~(before & (x == y[:, k:k + 1])).any(axis=1)
    return out


def _compare(table: pa.Table, threshold: float) -> pa.Table:
    """New links and the local root of each vector of a leaf (or of a pair of its blocks)."""
    node = table.column("node").to_numpy()
    n = len(node)
    unit = _unit(_lists(table.column("embedding"))[0].reshape(n, -1))
    times, block = table.column("times").to_numpy(), table.column("block").to_numpy()
    first, second = (int(x) for x in table.column("blocks")[0].as_py().split("-"))
    here = int(table.column("tree")[0].as_py()) << 32 | int(table.column("leaf")[0].as_py())
    linked = unit @ unit.T >= threshold
    if first != second:  # pairs within one block are another group's
        linked &= block[:, None] != block[None, :]
    np.fill_diagonal(linked, False)
    a, b = np.nonzero(np.triu(linked))
    new = _first_shared(*_lists(table.column("leaves")), a, b, here) if len(a) else np.zeros(0, bool)
    links = np.bincount(a[new], times[b[new]], n) + np.bincount(b[new], times[a[new]], n)
    root = np.arange(n)
    while len(a):  # the smallest place that links reach, by halving paths
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            break
        root = low
    keep = (links > 0) | (root != np.arange(n))
    return pa.table([pa.array(node[keep]), pa.array(links[keep].astype(np.int64)), pa.array(node[root[keep]])],
                    names=["node", "n_links", "root"])


def _valid(vector: str):
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0) & F.col("label").isNotNull()


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.93, trees: int = 10, spill: float = 0.05, leaf: int = 512, block: int = 1024,
                    sample: int = 20_000) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    ok = F.coalesce(_valid("embedding"), F.lit(False))
    rows = rows.withColumn("node", F.when(ok, F.xxhash64("label", "embedding")))
    distinct = stored(rows.where("node is not null").groupBy("node", "label", "embedding").agg(F.count(F.lit(1)).alias("times")),
                      "vectors")
    sizes = distinct.groupBy("label", F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    total = distinct.count()
    share = F.pmod(F.xxhash64("node", F.lit(6)), F.lit(1 << 30))
    top = int(min(1 << 30, sample / max(1, total) * (1 << 30)))
    fit = distinct.where(share < top).limit(sample).select("label", "embedding").collect()
    by_group = {}
    for r in fit:
        by_group.setdefault((r["label"], len(r["embedding"])), []).append(r["embedding"])
    # Groups without a sampled vector hold about total / sample vectors at most: one leaf.
    wanted = {(r["label"], r["dim"]): r["n"] for r in sizes.where(F.col("n") > leaf).orderBy(F.desc("n")).limit(sample).collect()}
    forest = {}
    for group, found in by_group.items():
        # A child holds 0.5 + spill of its node.
        depth = np.ceil(np.log(max(1.0, wanted.get(group, 1) / leaf)) / -np.log(0.5 + spill))
        depth = min(_MAX_DEPTH, int(depth))
        if depth:
            forest[f"{group[0]}/{group[1]}"] = fit_cuts(np.array(found), trees, depth, spill)
    shared = spark.sparkContext.broadcast(forest)
    routed = distinct.mapInArrow(partial(_route, shared=shared, trees=trees),
                                 "node long, label string, tree long, leaf long, times long, embedding array<double>, leaves array<long>")
    # A large leaf is cut into blocks by hash; each pair of blocks is a group.
    counts = routed.groupBy("label", "tree", "leaf").agg(F.count(F.lit(1)).alias("c"))
    cut = routed.join(counts, ["label", "tree", "leaf"]).withColumn("k", F.ceil(F.col("c") / block).cast("int"))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("k") - 1),
                        lambda j: F.concat(F.least(F.col("block"), j).cast("string"), F.lit("-"), F.greatest(F.col("block"), j).cast("string")))
    dealt = cut.withColumn("blocks", F.explode(pairs))
    found = stored(dealt.groupBy("label", "tree", "leaf", "blocks").applyInArrow(
        lambda table: _compare(table, threshold), "node long, n_links long, root long"), "links")
    links = found.groupBy("node").agg(F.sum("n_links").alias("links"))
    comps = components(found, "node", "root")
    own = rows.select("vec_id", "node")
    told = (own.join(distinct.select("node", "times"), "node", "left").join(links, "node", "left").join(comps, "node", "left")
            .withColumn("comp", F.coalesce("component", "node")))
    least = told.where("comp is not null").groupBy("comp").agg(F.min("vec_id").alias("least"))
    told = told.join(least, "comp", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return told.select("vec_id", F.coalesce(F.col("times") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
                       component.alias("component_id"),
                       F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
