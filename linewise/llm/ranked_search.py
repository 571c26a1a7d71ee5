"""Ranked lexical search: the best documents of each query item, by presence masks.

Every document is searched for every item.  A task cuts its documents into
segments and keeps, for a segment, one bitmap per term (which documents hold
it).  For an item the bitmaps of its terms are turned into one mask per
document (which terms it holds); documents of equal mask form a group, and the
group's highest possible score follows from its mask, the largest counts of the
segment and its shortest document.  Groups are opened in falling order of that
bound, until it is below the last place of the item's list: no later group can
enter.  The lists are kept over all segments of a task, so later segments open
few groups.  Tasks return at most ``k`` rows an item; Spark ranks those.

Corpus counts (documents with terms, all terms, documents per term) come from a
pass over all documents before.  Items are worked through in blocks of bounded
size, one broadcast alive at a time; results of a block are stored.

Scores: ``w = floor(1000*ln((2N+2)/(2df+1)))``, ``m = 100-b + (b*n*N) div L``,
a term adds ``w * ((10^9*tf) div (1000*tf + 8m))`` as often as the item holds it.

Cases: a null or empty text has no terms, is not counted in N and is never
found; an item without terms has no rows; equal (id, text) items count once, two
texts under one id are two items; repeated documents are ranked one by one, a
null doc_id after all others on equal scores; empty tables give no rows; columns
besides the named ones are not read.  Texts are counted in pieces, so a very
long one costs its distinct terms.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linewise.llm.tables import empty, stored

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_PIECE = 1 << 20
#: A segment ends at so many documents or so many (document, term) entries.
SEGMENT_DOCS, SEGMENT_ENTRIES = 4096, 1 << 18
#: Cells at most of a segment's table of an item's terms by documents (64 documents at least).
SEGMENT_CELLS = 1 << 23
#: Bytes of item texts searched at a time: bounds the driver and the broadcast.
BLOCK_BYTES = 2 << 20


def term_counts(text: str | None) -> Counter:
    """Occurrences of each term (bytes) in the whole text; only A-Z is lower-cased."""
    counts: Counter = Counter()
    if not text:
        return counts
    raw, at = text.encode().lower(), 0
    while at < len(raw):
        stop = min(len(raw), at + _PIECE)
        if stop < len(raw):  # a piece ends where a term ends
            gap = _GAP.search(raw, stop)
            stop = gap.start() if gap else len(raw)
        counts.update(_TERM.findall(raw, at, stop))
        at = stop
    return counts


def _item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list]:
    """Lists of (item, text), each of about ``block_bytes``; a block is a hash range of the items."""
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_bytes))
    key = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for b in range(blocks):
        rows = items.where(key == b).orderBy("item", "text").collect()
        if rows:
            yield [(r["item"], r["text"]) for r in rows]


def _corpus_counts(docs: DataFrame, vocabulary) -> tuple[int, int, dict[int, int]]:
    """Documents with terms, all terms, and documents per vocabulary term, over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found, n_docs, n_terms = vocabulary.value, Counter(), 0, 0
        for batch in batches:
            for text in batch.column(0):
                counts = term_counts(text.as_py())
                if counts:
                    n_docs += 1
                    n_terms += counts.total()
                    found.update(known.keys() & counts.keys())
        rows = [(-2, n_docs), (-1, n_terms), *((known[t], c) for t, c in found.items())]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())],
                              names=["term", "c"])

    got = {r["term"]: r["c"] for r in docs.select("text").mapInArrow(run, "term long, c long")
           .groupBy("term").agg(F.sum("c").alias("c")).collect()}
    return got.pop(-2, 0), got.pop(-1, 0), got


class _Item:
    """A query item: its distinct terms, their factors, and the best documents so far."""

    def __init__(self, terms: np.ndarray, factors: np.ndarray, k: int):
        self.terms, self.factors, self.k = terms, factors, k
        self.best: list[tuple] = []  # a heap: worst first

    def offer(self, score: int, doc) -> None:
        # A smaller id wins a tie; a null id comes last.
        entry = (score, doc is not None, 0 if doc is None else -doc)
        if len(self.best) < self.k:
            heapq.heappush(self.best, entry)
        elif entry > self.best[0]:
            heapq.heapreplace(self.best, entry)

    def least(self) -> int:
        """A lower score cannot enter; scores of 0 never do."""
        return self.best[0][0] if len(self.best) == self.k else 1


def _masks(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one document of each distinct mask, mask number of each document) of a terms x documents bit table."""
    packed = np.ascontiguousarray(np.packbits(present, axis=0).T)
    if packed.shape[1] <= 8:
        wide = np.zeros((len(packed), 8), np.uint8)
        wide[:, :packed.shape[1]] = packed
        keys = wide.view(np.uint64).ravel()
    else:
        keys = packed.view(np.dtype((np.void, packed.shape[1]))).ravel()
    _, first, group = np.unique(keys, return_index=True, return_inverse=True)
    return first, group


class _Segment:
    """Documents of a task, searched together; ``docs`` bounds their number."""

    def __init__(self, docs: int):
        self.docs = docs
        self.ids: list = []
        self.norms: list[int] = []
        self.counts: list[dict[int, int]] = []
        self.entries = 0

    def add(self, doc, norm: int, counts: dict[int, int]) -> None:
        self.ids.append(doc)
        self.norms.append(norm)
        self.counts.append(counts)
        self.entries += len(counts)

    def full(self) -> bool:
        return len(self.ids) >= self.docs or self.entries >= SEGMENT_ENTRIES

    def search(self, items: list[_Item], n_terms: int) -> None:
        size = len(self.ids)
        if not size:
            return
        term = np.fromiter((t for c in self.counts for t in c), np.int64, self.entries)
        many = np.fromiter((v for c in self.counts for v in c.values()), np.int64, self.entries)
        place = np.repeat(np.arange(size), [len(c) for c in self.counts])
        order = np.argsort(term, kind="stable")
        many, place = many[order], place[order]
        here, row = np.unique(term[order], return_inverse=True)
        starts = np.searchsorted(row, np.arange(len(here) + 1))
        # Bitmaps of the terms that occur here, one row each.
        bits = np.zeros((len(here), -(-size // 8)), np.uint8)
        np.bitwise_or.at(bits, (row, place >> 3), (128 >> (place & 7)).astype(np.uint8))
        # What a term adds at most in this segment.
        most = np.maximum.reduceat(many, starts[:-1])
        gain = (1_000_000_000 * most) // (1000 * most + 8 * min(self.norms))
        norms = 8 * np.array(self.norms, np.int64)
        row_of = np.full(n_terms, -1, np.int64)
        row_of[here] = np.arange(len(here))
        for item in items:
            rows = row_of[item.terms]
            shown = rows >= 0
            rows, factors = rows[shown], item.factors[shown]
            top = gain[rows] * factors
            if int(top.sum()) < item.least():
                continue
            present = np.unpackbits(bits[rows], axis=1, count=size)
            first, group = _masks(present)
            bounds = top @ present[:, first]
            falling = np.argsort(-bounds, kind="stable")
            bounds = bounds[falling]
            at, step = 0, 16
            # Masks are opened some at a time, until no later one can enter.
            while at < len(falling) and bounds[at] >= item.least():
                end = min(at + step, int(np.searchsorted(-bounds, -item.least(), side="right")))
                opened = np.zeros(len(first), bool)
                opened[falling[at:end]] = True
                docs = np.flatnonzero(opened[group])
                held = np.zeros((len(rows), size), np.int64)
                for t, r in enumerate(rows):
                    held[t, place[starts[r]:starts[r + 1]]] = many[starts[r]:starts[r + 1]]
                held = held[:, docs]
                scores = factors @ ((1_000_000_000 * held) // (1000 * held + norms[docs]))
                for d in np.flatnonzero(scores >= item.least()):
                    item.offer(int(scores[d]), self.ids[docs[d]])
                at, step = end, 4 * step


def _search_block(docs: DataFrame, block: list, k: int, length_share: int, kinds: tuple[str, str]) -> DataFrame:
    spark = docs.sparkSession
    counted = [term_counts(text) for _, text in block]
    names = sorted(set().union(*counted))
    numbers = {t: i for i, t in enumerate(names)}
    vocabulary = spark.sparkContext.broadcast(numbers)
    n_docs, n_terms, df = _corpus_counts(docs, vocabulary)
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(names))]
    query = []
    for counts in counted:
        # Terms that no document holds add nothing.
        terms = [(numbers[t], c * weight[numbers[t]]) for t, c in sorted(counts.items()) if numbers[t] in df]
        query.append((np.array([t for t, _ in terms], np.int64), np.array([f for _, f in terms], np.int64)))
    queries = spark.sparkContext.broadcast(query)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        items = [_Item(terms, factors, k) for terms, factors in queries.value]
        wanted = [i for i in items if len(i.terms)]
        widest = max((len(i.terms) for i in wanted), default=1)
        docs_at_once = max(64, min(SEGMENT_DOCS, SEGMENT_CELLS // widest))
        segment = _Segment(docs_at_once)
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                counts = term_counts(text.as_py())
                if not counts:
                    continue
                held = {known[t]: counts[t] for t in known.keys() & counts.keys()}
                if held:
                    norm = 100 - length_share + (length_share * counts.total() * n_docs) // n_terms
                    segment.add(doc.as_py(), norm, held)
                    if segment.full():
                        segment.search(wanted, len(known))
                        segment = _Segment(docs_at_once)
        segment.search(wanted, len(known))
        rows = [(i, -e[2] if e[1] else None, e[0]) for i, item in enumerate(items) for e in item.best]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                               pa.array([r[2] for r in rows], pa.int64())], names=["item", "doc_id", "score"])

    found = docs.mapInArrow(run, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ids = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], f"item int, item_id {kinds[0]}")
    result = stored(ranked.join(F.broadcast(ids), "item").select(
        "item_id", "rank", F.col("doc_id").cast(kinds[1]).alias("doc_id"), "score"), "ranked")
    vocabulary.unpersist()
    queries.unpersist()
    return result


def ranked_search(docs: DataFrame, items: DataFrame, *, k: int = 10, length_share: int = 75, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` documents of highest score above 0 of each item.

    ``length_share`` is the percentage b by which length counts (see the module
    for the score and the cases).  Documents need integer ids.
    """
    spark = docs.sparkSession
    kinds = (items.schema[item_id].dataType.simpleString(), docs.schema[doc_id].dataType.simpleString())
    table = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    wanted = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).distinct()
    out = None
    for block in _item_blocks(wanted, block_bytes):
        part = _search_block(table, block, k, length_share, kinds)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else empty(spark, f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
