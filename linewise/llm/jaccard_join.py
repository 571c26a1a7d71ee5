"""Operator 1: n-gram Jaccard join by a token-group matrix.

A text is the set of its word shingles.  Two texts link when their sets'
Jaccard similarity is at least ``threshold`` (4/5); the result is each
document's connected component.  The join is exact on 64-bit shingle hashes.

1. Rows with equal sets become one *set* (keyed by a 64-bit digest), so copies
   never meet each other again.
2. Every set is written in one global token order (frequent tokens last).  Two
   sets that link share a token among the first ``n - ceil(t n) + 1`` of each.
   These tokens travel in packed blocks by token hash; tokens of one set only
   are dropped.
3. Groups of similar sets: each set is compared with a few leaders (one set) of the
   tokens that it shares; linked sets form a group.
   Then each set is compared with a few members of a few groups, and groups that
   these links join become one.
4. Token-group matrix: groups that share their most common token form a family,
   and the matrix holds the union of each family's tokens.  For a set ``q`` and
   a family ``G`` the number of ``q``'s tokens in ``G``'s union bounds the overlap with
   any member; only families that reach the bound open, and ``q`` is compared with
   their members of other groups, first by the tokens that both prefixes hold, then
   as whole sets.  Within a group nothing is compared again, so a group of
   linked copies costs no quadratic work; sets of one family that do not link
   are compared once each, in blocks.
5. Components over the links.

Edge cases: a null text or one without words has ``n_shingles`` 0 and links
with nothing (``component_id`` = its doc_id).  Repeated rows and ties are equal
sets.  A null doc_id keeps its row; the component id is the smallest doc_id that
is not null (null if there is none).  Extra columns are ignored.  An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewise.llm import packed
from linewise.llm.tables import components, forget, stored
from linewise.llm.text_arrays import PIECE, PLACE, mix, signed, slices, text_buffer, unsigned, window_hashes, words_of

#: At most so many frequent tokens are put last in the token order (8 MB; order only).
MAX_FREQUENT = 1 << 20
#: Rows at most in the broadcast that keeps texts of other sets out of a shuffle.
NEAR = 1 << 20
_BLOCK_TOKENS = 1 << 22
#: Prefix entries that are packed at once: at 20 bytes each, some 50 MB with the copies made of them.
_BLOCK_ENTRIES = 1 << 19
#: Leaders that a set is compared with in a round, and groups and members of a group before all of them.
ATTEMPTS, FEW = 8, 4
#: Members of a family that one block of comparisons holds.
_BLOCK_SETS = 256
_TOP = np.uint64(1 << 63)


def shingle_sets(column: pa.Array, n_words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text (a short text is one shingle)."""
    buf, offs = text_buffer(column)
    words, _, _, first = words_of(buf, offs, lower=True)
    grams = window_hashes(words, n_words)
    for lo, hi in zip(first[:-1], first[1:]):
        if hi - lo >= n_words:
            yield np.unique(grams[lo:hi - n_words + 1])
        elif hi > lo:
            short = words[lo:hi]
            yield mix((short * PLACE[:len(short)]).sum(dtype=np.uint64) + np.array([len(short)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _digest(tokens: np.ndarray) -> int:
    """One 64-bit key of a set: independent of the order, with the size mixed in."""
    size = np.array([len(tokens)], np.uint64) * PLACE[41]
    return int(mix(mix(tokens ^ PLACE[40]).sum(dtype=np.uint64) + size).view(np.int64)[0])


def prefix_length(n: int, num: int, den: int) -> int:
    """Tokens of a set of ``n`` among which any linked set must share one."""
    return n - -(-num * n // den) + 1 if n else 0


_SETS = pa.schema([("kind", pa.int8()), ("doc_id", pa.int64()), ("text_key", pa.int64()),
                   ("node", pa.int64()), ("n", pa.int64())])


def _measure(batches, n_words: int):
    """Each row's set key and size (kind 0), and tokens that several sets of a block have (kind 1: token, sets)."""
    held, seen, count = [], set(), 0

    def frequent():
        tokens = np.concatenate(held)
        held.clear()
        tokens.sort()
        again = tokens[1:] == tokens[:-1]
        first = np.flatnonzero(again & ~np.append(False, again[:-1]))
        last = np.flatnonzero(again & ~np.append(again[1:], False)) + 1
        k = len(first)
        return pa.record_batch([pa.array(np.ones(k, np.int8)), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                                pa.array(signed(tokens[first])), pa.array(last - first + 1)], schema=_SETS)

    for batch in batches:
        for part in slices(batch, "text", size=PIECE):
            sets = list(shingle_sets(part.column("text"), n_words))
            keys = [_digest(s) if len(s) else None for s in sets]
            yield pa.record_batch([
                pa.array(np.zeros(len(sets), np.int8)), part.column("doc_id"), part.column("text_key"),
                pa.array(keys, pa.int64()), pa.array([len(s) for s in sets], pa.int64())], schema=_SETS)
            for s, key in zip(sets, keys):
                if len(s) and key not in seen:
                    seen.add(key)
                    held.append(s)
                    count += len(s)
            if count >= _BLOCK_TOKENS:
                yield frequent()
                held, seen, count = [], set(), 0
    if count:
        yield frequent()


class _Order:
    """The global token order: rare tokens by hash, then frequent ones by hash."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = np.sort(frequent)

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.frequent) or not len(tokens):
            return tokens
        at = np.minimum(np.searchsorted(self.frequent, tokens), len(self.frequent) - 1)
        late = self.frequent[at] == tokens
        return np.concatenate([tokens[~late], tokens[late]])


_DTYPES = ("u8", "i8", "i4")


def _prefixes(batches, n_words: int, num: int, den: int, buckets: int, order):
    """Packed (token, set, size) entries of the prefixes in blocks; a set once in a batch."""
    frequent = _Order(order.value)

    def block():
        t = np.concatenate(tokens)
        return packed.to_batch(packed.blocks((mix(t) % np.uint64(buckets)).astype(np.int32),
                                             [t, np.concatenate(nodes), np.concatenate(sizes)]))

    for batch in batches:
        seen, tokens, nodes, sizes, held = set(), [], [], [], 0
        for part in slices(batch, "text", size=PIECE):
            for s in shingle_sets(part.column("text"), n_words):
                if len(s) and (node := _digest(s)) not in seen:
                    seen.add(node)
                    p = prefix_length(len(s), num, den)
                    tokens.append(frequent(s)[:p].copy())
                    nodes.append(np.full(p, node, np.int64))
                    sizes.append(np.full(p, len(s), np.int32))
                    held += p
            if held >= _BLOCK_ENTRIES:
                yield block()
                tokens, nodes, sizes, held = [], [], [], 0
        if tokens:
            yield block()


def _several(columns) -> pa.RecordBatch:
    """Distinct (token, set, size) entries of the tokens that more than one set has."""
    token, node, size = columns
    order = np.lexsort((node, token))
    token, node, size = token[order], node[order], size[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
    token, node, size = token[new], node[new], size[new]
    same = np.zeros(len(token), bool)
    same[1:] = token[1:] == token[:-1]
    same[:-1] |= same[1:].copy()
    return pa.record_batch([pa.array(signed(token[same])), pa.array(node[same]), pa.array(size[same].astype(np.int64))],
                           names=["token", "node", "n"])


def _tokens(batches, n_words: int):
    for batch in batches:
        for part in slices(batch, "text", size=PIECE):
            sets = list(shingle_sets(part.column("text"), n_words))
            yield pa.record_batch([pa.array([_digest(s) if len(s) else None for s in sets], pa.int64()),
                                   pa.array([signed(s) for s in sets], pa.list_(pa.int64()))], names=["node", "tokens"])


def _reaches(n_a, n_b, shared, num: int, den: int):
    """Upper bound test: can sets of these sizes link when their prefixes share so many tokens?

    All shared tokens up to the smaller of the two last prefix tokens are
    counted, so the overlap is at most ``shared`` plus what one set has beyond
    its prefix: ``n - p`` = ceil(t n) - 1.
    """
    beyond = F.ceil(F.lit(num) * F.greatest(n_a, n_b) / F.lit(den)) - 1
    return (den + num) * (shared + beyond) >= num * (n_a + n_b)


def _fits(n_a, n_b, num: int, den: int):
    return (den * F.least(n_a, n_b)) >= (num * F.greatest(n_a, n_b))


def _token_sets(nodes: DataFrame, per_doc: DataFrame, rows: DataFrame, n_words: int) -> DataFrame:
    """node, tokens of the given sets: one text of each is shingled again."""
    wanted = (per_doc.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("text_key").alias("text_key")))
    near = wanted.select(F.pmod("text_key", F.lit(NEAR)).alias("near")).distinct()  # NEAR rows at most
    texts = (rows.join(F.broadcast(near), F.pmod("text_key", F.lit(NEAR)) == F.col("near"), "left_semi")
             .join(wanted.select("text_key"), "text_key", "left_semi").dropDuplicates(["text_key"]))
    return stored(texts.select("text").mapInArrow(partial(_tokens, n_words=n_words), "node long, tokens array<long>"), "tokens")


def _verified(pairs: DataFrame, per_doc: DataFrame, rows: DataFrame, n_words: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of sets that link; only the sets of these pairs are made whole."""
    pairs = stored(pairs.select("a", "b"), "pairs")  # read twice
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _token_sets(nodes, per_doc, rows, n_words)
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b")
    inter = F.size(F.array_intersect("ta", "tb"))
    linked = both.where(den * inter >= num * (F.size("ta") + F.size("tb") - inter)).select("a", "b")
    found = stored(linked, "found")
    forget(pairs, sets)
    return found


def _prefix_arrays(shared: DataFrame) -> DataFrame:
    """node, n, head: the prefix tokens of a set that other sets have too, in one row."""
    return stored(shared.groupBy("node", "n").agg(F.collect_list("token").alias("head")), "heads")


def _hopeful(heads: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose prefixes share enough tokens for a link."""
    a = heads.select(F.col("node").alias("a"), "n", F.col("head").alias("x"))
    b = heads.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("head").alias("y"))
    return pairs.join(a, "a").join(b, "b").where(_heads_reach(num, den)).select("a", "b")


def _heads_reach(num: int, den: int):
    return _reaches(F.col("n"), F.col("m"), F.size(F.array_intersect("x", "y")), num, den)


def _led(rows: DataFrame, heads: DataFrame, salt: int, num: int, den: int) -> DataFrame:
    """Pairs of a set and a few leaders of tokens that it shares, if the counts allow a link.

    Every token has a leader for each class of sizes, drawn by hash, so sets of
    one family meet different members of it.
    """
    rank = F.struct(F.xxhash64("node", "token", F.lit(salt)).alias("h"), F.col("node"), F.col("n"), F.col("grp"))
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(den / num) + F.lit(0.5 * (salt % 2)))
    banded = rows.withColumn("band", band)
    leaders = banded.groupBy("token", "band").agg(F.min(rank).alias("lead"), F.count(F.lit(1)).alias("c"))
    met = (banded.join(leaders.where("c > 1"), ["token", "band"])
           .where(F.col("grp") != F.col("lead.grp")).where(_fits(F.col("n"), F.col("lead.n"), num, den))
           .select(F.col("node").alias("a"), F.col("lead.node").alias("b")).distinct())
    # Leaders of a set: at most as many as its prefix has tokens.
    tried = met.groupBy("a").agg(F.array_sort(F.collect_list(F.struct(F.xxhash64("a", "b"), F.col("b")))).alias("to"))
    pairs = tried.select("a", F.explode(F.slice("to", 1, ATTEMPTS)).alias("to")).select("a", F.col("to.b").alias("b"))
    return _hopeful(heads, pairs, num, den)


def _merged(comps: DataFrame | None, found: DataFrame) -> DataFrame:
    """node, component after more links: only the components so far are joined further, not their nodes again."""
    if comps is None:
        return stored(components(found, "a", "b"), "comps")
    def mapped(side: str):
        of = comps.select(F.col("node").alias(side), F.col("component").alias(f"{side}_comp"))
        return of, F.coalesce(f"{side}_comp", side).alias(side)
    (of_a, comp_a), (of_b, comp_b) = mapped("a"), mapped("b")
    between = found.join(of_a, "a", "left").join(of_b, "b", "left").select(comp_a, comp_b).where("a != b")
    moved = stored(components(between, "a", "b"), "moved")
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
    older = comps.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    newer = moved.join(comps, "node", "left_anti").select("node", "component")
    merged = stored(older.unionByName(newer), "comps")
    forget(comps, moved)
    return merged


def _grouped(shared: DataFrame, comps: DataFrame) -> DataFrame:
    grp = comps.select("node", F.col("component").alias("grp"))
    return shared.join(grp, "node", "left").withColumn("grp", F.coalesce("grp", "node"))


def _crossing(grouped: DataFrame) -> DataFrame:
    """The entries of the tokens that sets of several groups share."""
    several = (grouped.groupBy("token").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"))
               .where("lo != hi").select("token"))
    return stored(grouped.join(several, "token"), "crossing")


def _matrix(rows: DataFrame, key: str = "grp") -> DataFrame:
    """The token-group matrix: a row for each token of a group's union."""
    return rows.groupBy("token", F.col(key).alias("g")).agg(F.min("n").alias("least_n"), F.max("n").alias("most_n"))


def _members(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("grp").alias("g")).distinct()


def _asks(num: int, den: int, key: str = "grp"):
    """Either direction finds a pair, so a set asks only groups of a larger id, with members of a fitting size."""
    return ((F.col(key) < F.col("g")) & (den * F.col("n") >= num * F.col("least_n"))
            & (den * F.col("most_n") >= num * F.col("n")))


def _sampled(rows: DataFrame, heads: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of a set and a few members of a few groups that share a token, dealt by hash: linear in the entries."""
    def few_of(table: DataFrame, key: str) -> DataFrame:
        held = table.groupBy(key).agg(F.count(F.lit(1)).alias("held"))
        return held.select(key, F.greatest(F.floor(F.col("held") / FEW), F.lit(1).cast("long")).alias(f"{key}_slots"))

    def slot(of: str, slots: str):
        return F.pmod(F.xxhash64(of), F.col(slots))

    matrix = _matrix(rows)
    groups = few_of(matrix, "token")
    asking = rows.join(groups, "token").withColumn("place", slot("node", "token_slots"))
    offered = matrix.join(groups, "token").withColumn("place", slot("g", "token_slots")).drop("token_slots")
    met = (asking.join(offered, ["token", "place"]).where(_asks(num, den))
           .select(F.col("node").alias("a"), "n", "g").distinct())
    some = (met.join(few_of(met, "a"), "a").where(slot("g", "a_slots") == slot("a", "a_slots"))
            .join(few_of(_members(rows), "g"), "g").withColumn("slot", slot("a", "g_slots")))
    dealt = _members(rows).join(few_of(_members(rows), "g"), "g").withColumn("slot", slot("b", "g_slots")).drop("g_slots")
    pairs = some.join(dealt, ["g", "slot"]).where(_fits(F.col("n"), F.col("m"), num, den)).select("a", "b")
    return _hopeful(heads, pairs, num, den)


def _families(rows: DataFrame) -> DataFrame:
    """The entries with ``fam``: groups whose most shared token (by number of groups) is the same are one family.

    Sets that are similar, but not enough to link, share most of their tokens;
    with a row for each of them the token-group matrix would meet each token
    as often as its sets squared.  The groups of a family share a token, so
    the comparisons inside it are some of those that this one token asks for.
    """
    held = stored(rows.groupBy("token", "grp").agg(F.count(F.lit(1)).alias("c")), "held")
    known = held.groupBy("token").agg(F.count(F.lit(1)).alias("known"))
    fams = (held.join(known, "token").groupBy("grp")
            .agg(F.max_by("token", F.struct("known", "token")).alias("fam")))
    families = stored(rows.join(fams, "grp"), "families")
    forget(held)
    return families


def _opened(rows: DataFrame, heads: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (set, member of another group) of the families that the token-group matrix opens."""
    asked = (rows.join(_matrix(rows, "fam"), "token").where(_asks(num, den, "fam"))
             .groupBy(F.col("node").alias("a"), "n", "grp", "g")
             .agg(F.count(F.lit(1)).alias("c"), F.min("least_n").alias("least_n"), F.max("most_n").alias("most_n")))
    smallest = F.greatest(F.col("least_n"), F.ceil(num * F.col("n") / F.lit(den)))
    largest = F.least(F.col("most_n"), F.floor(den * F.col("n") / F.lit(num)))
    beyond = F.ceil(num * F.greatest(F.col("n"), largest) / F.lit(den)) - 1
    qualifying = asked.where((den + num) * (F.col("c") + beyond) >= num * (F.col("n") + smallest))
    members = rows.select("node", "n", "grp", "fam").distinct()
    own = members.select(F.col("node").alias("a"), "n", "grp", F.col("fam").alias("g"))  # its union holds all of them
    blocks = members.groupBy(F.col("fam").alias("g")).agg(F.count_distinct("grp").alias("groups"), F.expr(
        f"(count(1) + {_BLOCK_SETS - 1}) div {_BLOCK_SETS}").alias("blocks")).withColumn("several", F.col("groups") > 1)
    opened = (qualifying.select("a", "n", "grp", "g", F.lit(False).alias("own"))
              .unionByName(own.withColumn("own", F.lit(True))).join(blocks, "g").where("several or not own")
              .join(heads.select(F.col("node").alias("a"), F.col("head").alias("x")), "a")
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    dealt = (members.withColumnsRenamed({"node": "b", "n": "m", "grp": "other", "fam": "g"}).join(blocks, "g")
             .join(heads.select(F.col("node").alias("b"), F.col("head").alias("y")), "b")
             .select("b", "m", "other", "g", "y", F.pmod(F.xxhash64("b"), "blocks").alias("block")))
    # What the family's union allows is asked of each member by the tokens shared with it, inside the join.
    asks = F.when(F.col("own"), F.col("grp") < F.col("other")).otherwise(F.lit(True))
    o, d = opened.alias("o"), dealt.alias("d")
    return (o.join(d, (F.col("o.g") == F.col("d.g")) & (F.col("o.block") == F.col("d.block")) & asks
                   & _fits(F.col("n"), F.col("m"), num, den) & _heads_reach(num, den))
            .select("a", "b"))


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n_words: int = 5,
                       threshold: tuple[int, int] = (4, 5), leader_rounds: int = 1) -> DataFrame:
    """doc_id, n_shingles, component_id; ``set_key`` (equal for rows with equal sets),
    ``component_key`` (equal in a component, also without ids) and ``text_key`` (hash of the text)."""
    num, den = threshold
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("text_key"))
    measured = stored(rows.mapInArrow(partial(_measure, n_words=n_words),
                                      "kind byte, doc_id long, text_key long, node long, n long"), "sets")
    per_doc = measured.where("kind = 0").select("doc_id", "text_key", "node", "n")
    # Frequent tokens: counted in blocks over all rows; at most MAX_FREQUENT of them leave Spark.
    often = (measured.where("kind = 1").groupBy("node").agg(F.sum("n").alias("c")).where("c >= 16")
             .orderBy(F.desc("c"), "node").limit(MAX_FREQUENT).select("node"))
    order = spark.sparkContext.broadcast(unsigned(often.toPandas()["node"].to_numpy()))
    buckets = packed.bucket_count(rows, "text")
    entries = rows.select("text").mapInArrow(
        partial(_prefixes, n_words=n_words, num=num, den=den, buckets=buckets, order=order), packed.SCHEMA)
    shared = stored(packed.by_bucket(entries, _several, "token long, node long, n long", _DTYPES), "shared")

    verified = partial(_verified, per_doc=per_doc, rows=rows, n_words=n_words, num=num, den=den)
    heads = _prefix_arrays(shared)
    comps, grouped = None, shared.withColumn("grp", F.col("node"))
    for r in range(leader_rounds):
        comps = _merged(comps, verified(_led(grouped, heads, r, num, den)))
        grouped = _grouped(shared, comps)
    # A few members of a few groups first: one link joins a set to a group, and most pairs need no more.
    crossing = _crossing(grouped)
    comps = _merged(comps, verified(_sampled(crossing, heads, num, den)))
    forget(crossing)
    crossing = _crossing(_grouped(shared, comps))
    families = _families(crossing)
    forget(crossing, shared)
    comps = _merged(comps, verified(_opened(families, heads, num, den)))
    forget(families, heads)

    comps = comps.withColumnRenamed("component", "comp")
    keyed = per_doc.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    keyed = stored(keyed.select("doc_id", "text_key", "node", "n", "comp"), "keyed")
    least = keyed.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    out = keyed.join(least, "comp", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
                      F.col("node").alias("set_key"), F.col("comp").alias("component_key"), "text_key")


def keep_one_per_component(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without near copies: one row of each component stays, that with the smallest doc_id.

    Rows without words link with nothing and all stay.  A null doc_id comes
    after all others; of rows with the same doc_id the one with the smallest
    text hash stays, and of repeated rows (same doc_id, same text) one.
    """
    found = stored(jaccard_components(docs, id_col=id_col, text_col=text_col, **options)
                   .where("set_key is not null"), "components")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    first = found.groupBy("component_key").agg(F.min(rank).alias("first"))
    acts = (found.groupBy("component_key", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("times"))
            .join(first, "component_key").withColumn("stays", rank.eqNullSafe(F.col("first")))
            .where("not stays or times > 1")
            .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("stays").alias("__stays")))
    told = (docs.withColumn("__text_key", F.xxhash64(F.col(text_col)))
            .join(acts, F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key")), "left"))
    once = told.where("__stays").dropDuplicates(["__id", "__key"])
    return told.where("__stays is null").unionByName(once).select(*[f"`{c}`" for c in docs.columns])
