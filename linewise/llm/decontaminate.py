"""Operator 3: benchmark decontamination by q-gram lemma filtering.

Texts are compared in normal form: lower case, every run of ASCII signs and
spaces one space.  A document contains an item if it holds

* of an item of more than ``probe`` (100) bytes, any ``passage`` (50) bytes verbatim,
  wherever in it they begin, or a region within ``edits`` = 6 % of the length in edit
  operations of one of its probes: ``passage`` bytes every ``step`` (8) bytes, so any
  passage of 57 bytes or more holds a whole probe;
* of an item of ``least`` (30) to ``probe`` bytes, a region within 6 % of the whole item
  (a part of it is not enough);
* of a shorter item, the whole item verbatim from word edge to word edge (one of
  fewer than 12 bytes: only a document that is nothing else).

Filter: a region within ``e`` edits of a probe of length ``m`` keeps at least
``m - q + 1 - q e`` of its q-grams, on diagonals (place in the document minus
place in the probe) that differ by ``e`` at most.  Shared q-grams are counted in
diagonal bands of width 16 that overlap by half; bands that reach the bound are
regions to verify, by alignments banded around them, many at a time.

The probes go to the tasks as a broadcast of one block of the benchmark at a
time, of at most ``block_bytes`` (2 MB) of text; a larger benchmark takes more
passes over the documents.  A long document is worked through in overlapping
pieces.

Edge cases: null or empty texts match nothing, nor do items without letters or
digits.  Items with equal probes are all reported.  Null ids keep their rows
(``contaminated_documents`` reports the null doc_id).  Extra columns are ignored;
empty tables give empty results.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.text_arrays import byte_sums, mix, powers, slices

Q = 12
BAND = 16
_HALF = BAND // 2
_PIECE = 1 << 18
_BITS = 22
#: Alignments made at a time.
_TOGETHER = 4096

_TO_SPACE = np.arange(256, dtype=np.uint8)
for _c in range(128):
    if not chr(_c).isalnum():
        _TO_SPACE[_c] = 32


def normal(text: str) -> np.ndarray:
    raw = _TO_SPACE[np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)]
    space = raw == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    return raw[keep]


def _grams(raw: np.ndarray, n: int = Q) -> np.ndarray:
    if len(raw) < n:
        return np.zeros(0, np.uint64)
    sums = byte_sums(raw)
    return mix((sums[n:] - sums[:-n]) * powers(len(raw))[1][:len(raw) - n + 1])


def _entries_of(found: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``found``, entry) for each of the ``count`` entries of each found key."""
    n = count[found]
    entry = np.repeat(first[found] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
    return np.repeat(np.arange(len(found)), n), entry


class Probes:
    """The q-grams of a block of benchmark items, sorted, with the probes and places that have them; its passages."""

    def __init__(self, items: list[tuple[int, str]], probe: int, passage: int, step: int, rate: float, least: int):
        if not Q < passage <= 240 or not 0 < step <= passage - Q:
            raise ValueError(f"passage must be {Q + 1} to 240, step at most passage - {Q}")
        self.item, self.text, self.passage = [], [], passage
        self.brief, self.tiny = {}, {}
        grams, owner, place, windows, holder = [], [], [], [], []
        for item, text in items:
            raw = normal(text or "")
            raw = raw[int(len(raw) and raw[0] == 32):len(raw) - int(len(raw) > 1 and raw[-1] == 32)]
            if len(raw) < max(least, Q):
                if len(raw):
                    (self.tiny if len(raw) < Q else self.brief).setdefault(raw.tobytes(), []).append(item)
                continue
            m = len(raw)
            if m > max(probe, passage):
                m = passage
                verbatim = np.unique(_grams(raw, passage))
                windows.append(verbatim)
                holder.append(np.full(len(verbatim), item, np.int64))
            for at in sorted({*range(0, len(raw) - m + 1, step), len(raw) - m}):
                part = raw[at:at + m]
                found = _grams(part)
                grams.append(found)
                owner.append(np.full(len(found), len(self.item), np.int32))
                place.append(np.arange(len(found), dtype=np.uint8))
                self.item.append(item)
                self.text.append(part.tobytes())
        self.length = np.array([len(t) for t in self.text], np.int64)
        # The largest budget for which the bound still asks for a few shared grams.
        self.edits = np.minimum((self.length * rate).astype(np.int64), np.maximum(0, (self.length - Q - 2) // Q))
        self.bound = self.length - Q + 1 - Q * self.edits
        self.grams, self.first, self.count, order = self._sorted(grams)
        self.owner = (np.concatenate(owner) if owner else np.zeros(0, np.int32))[order]
        self.place = (np.concatenate(place) if place else np.zeros(0, np.uint8))[order]
        self.windows, self.window_first, self.window_count, order = self._sorted(windows)
        self.holder = (np.concatenate(holder) if holder else np.zeros(0, np.int64))[order]
        heads = {}
        for t in self.brief:
            heads.setdefault(int(_grams(np.frombuffer(t[:Q], np.uint8))[0]), []).append(t)
        self.heads, self.headed = np.array(sorted(heads), np.uint64), [heads[h] for h in sorted(heads)]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.grams >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    @staticmethod
    def _sorted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        keys = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        return *np.unique(keys[order], return_index=True, return_counts=True), order

    def known(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the grams that a probe has, and their indexes."""
        grams = _grams(raw)
        at = np.flatnonzero(self.seen[(grams >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not len(at) or not len(self.grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        where = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        hit = self.grams[where] == grams[at]
        return at[hit], where[hit]

    def verbatim(self, raw: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, start, end) of the maximal runs of passages that are found verbatim; ``at``: places of known grams."""
        full = self.passage - Q + 1  # probes overlap by more than a gram, so all grams of a passage are known
        if not len(at) or not len(self.windows) or len(raw) < self.passage:
            return []
        near = np.zeros(len(raw) + 1, np.int64)
        near[at + 1] = 1
        near = np.cumsum(near)
        m = len(raw) - self.passage + 1
        start = np.flatnonzero(near[full:full + m] - near[:m] == full)
        keys = _grams(raw, self.passage)[start]
        where = np.minimum(np.searchsorted(self.windows, keys), len(self.windows) - 1)
        hit = self.windows[where] == keys
        index, entry = _entries_of(where[hit], self.window_first, self.window_count)
        item, place = self.holder[entry], start[hit][index]
        order = np.lexsort((place, item))
        item, place = item[order], place[order]
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (place[1:] > place[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(item)) - 1 if len(first) else first
        return [(int(item[f]), int(place[f]), int(place[z]) + self.passage) for f, z in zip(first, last)]

    def briefly(self, raw: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, start, end) of the short items found whole, from word edge to word edge."""
        if not self.brief:
            return []
        grams, found = _grams(raw), []
        edge = np.ones(len(grams), bool)
        edge[1:] = raw[:len(grams) - 1] == 32 if len(grams) else edge[1:]
        at = np.flatnonzero(edge)
        where = np.minimum(np.searchsorted(self.heads, grams[at]), len(self.heads) - 1)
        hit = self.heads[where] == grams[at]
        for a, h in zip(at[hit].tolist(), where[hit].tolist()):
            for t in self.headed[h]:
                end = a + len(t)
                if raw[a:end].tobytes() == t and (end == len(raw) or raw[end] == 32):
                    found += [(item, a, end) for item in self.brief[t]]
        return found

    def regions(self, at: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probe, diagonal of a band's start) of the bands that reach the bound; known grams at ``at``."""
        index, entry = _entries_of(where, self.first, self.count)
        owner, place = self.owner[entry].astype(np.int64), self.place[entry].astype(np.int64)
        diagonal = at[index] - place
        # A probe's place counts once in a band.
        strip = (diagonal + (1 << 20)) // _HALF
        span = strip.max() + 2 if len(strip) else 1
        key = np.concatenate([owner * span + strip, owner * span + strip - 1])
        pair = np.unique(key * 256 + np.tile(place, 2))
        band, shared = np.unique(pair // 256, return_counts=True)
        probe = band // span
        enough = shared >= self.bound[probe]
        return probe[enough], (band % span)[enough] * _HALF - (1 << 20)

    def aligned(self, raw: np.ndarray, probe: np.ndarray, diagonal: np.ndarray) -> list[tuple[int, int, int]]:
        """(probe, end, edits) of the regions that are within the probe's edits."""
        out = []
        for m, e in sorted(set(zip(self.length[probe].tolist(), self.edits[probe].tolist()))):
            chosen = np.flatnonzero((self.length[probe] == m) & (self.edits[probe] == e))
            for k in range(0, len(chosen), _TOGETHER):
                some = chosen[k:k + _TOGETHER]
                texts = np.frombuffer(b"".join(self.text[p] for p in probe[some]), np.uint8).reshape(len(some), m)
                index, end, edits = banded_distances(texts, raw, diagonal[some] - e, BAND + 2 * e, e)
                out += zip(probe[some][index].tolist(), end.tolist(), edits.tolist())
        return out


def banded_distances(probes: np.ndarray, raw: np.ndarray, low: np.ndarray, width: int, limit: int):
    """(index, end, edits) of the probes (rows of equal length) that align within ``limit`` edits.

    A probe is aligned as a whole, anywhere on its diagonals low..low+width-1 of the
    text; ``end`` is the place after its best match.  Places outside the text hold
    a sign that no probe has, which costs what leaving out the probe's sign does.
    """
    m = probes.shape[1]
    pad = np.zeros(2 * (m + width), np.uint8)
    padded = np.concatenate([pad, raw, pad])
    first = np.clip(low, -(m + width), len(raw)) + len(pad)
    target = padded[first[:, None] + np.arange(m + width)]
    index, steps = np.arange(len(low)), np.arange(width, dtype=np.int16)
    row = np.zeros((len(low), width), np.int16)  # a match may begin anywhere
    above = np.full((len(low), width), limit + 1, np.int16)
    for i in range(m):
        above[:, :-1] = row[:, 1:]
        new = np.minimum(row + (target[:, i:i + width] != probes[:, i:i + 1]), above + 1) - steps
        row = np.minimum.accumulate(new, axis=1) + steps  # insertions along the row
        if i % 6 == 5 or i == m - 1:
            open_ = row.min(axis=1) <= limit
            if not open_.all():
                index, row, above = index[open_], row[open_], above[open_]
                target, probes = target[open_], probes[open_]
            if not len(index):
                break
    best = row.argmin(axis=1) if len(index) else index
    return index, np.clip(low[index] + m + best, 0, len(raw)), row[np.arange(len(index)), best]


def matches(probes: Probes, text: str) -> list[tuple[int, int, int, int]]:
    """(item, start, end, edits) of what is found; places count bytes of the normal form."""
    raw, found = normal(text), {}
    verbatim = {(item, start, end) for item, start, end in probes.briefly(raw)}
    if probes.tiny and len(raw) <= Q + 2:
        for item in probes.tiny.get(whole := raw.tobytes().strip(b" "), ()):
            verbatim.add((item, raw.tobytes().index(whole), raw.tobytes().index(whole) + len(whole)))
    for at in range(0, max(1, len(raw)), _PIECE):
        piece = raw[at:at + _PIECE + 512]
        places, where = probes.known(piece)
        if not len(places):
            continue
        verbatim |= {(item, at + start, at + end) for item, start, end in probes.verbatim(piece, places)}
        for p, end, edits in probes.aligned(piece, *probes.regions(places, where)):
            if p not in found or edits < found[p][2]:
                found[p] = (at + max(0, end - len(probes.text[p])), at + end, edits)
    return [(probes.item[p], *found[p]) for p in sorted(found)] + [(*v, 0) for v in sorted(verbatim)]


def _scan(batches, shared):
    probes = shared.value
    for batch in batches:
        for part in slices(batch, "text", 500):
            rows = []
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                by_item = {}
                for item, start, end, edits in matches(probes, text) if text else ():
                    n, s, e, least = by_item.get(item, (0, start, end, edits))
                    by_item[item] = (n + 1, min(s, start), max(e, end), min(least, edits))
                rows += [(doc, item, *x) for item, x in by_item.items()]
            cols = list(zip(*rows)) or [()] * 6
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols],
                                  names=["doc_id", "item_id", "n_probes", "span_start", "span_end", "edits"])


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """Lists of (item, text) of at most ``block_bytes`` of text (or one longer item)."""
    sized = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")).where("text is not null")
    held, size = [], 0
    for row in sized.orderBy("item").toLocalIterator():
        held.append((row["item"], row["text"]))
        size += len(row["text"])
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                           item_col: str = "item_id", item_text_col: str = "text", probe: int = 100, passage: int = 50,
                           step: int = 8, rate: float = 0.06, least: int = 30, block_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, item_id, n_probes, span_start, span_end, edits: one row for each document and item that it contains."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    schema = "doc_id long, item_id long, n_probes long, span_start long, span_end long, edits long"
    for items in benchmark_blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(Probes(items, min(probe, 240), passage, step, rate, least))
        found = rows.mapInArrow(partial(_scan, shared=shared), schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], schema)


def _clean(batches, shared, text_col):
    probes = shared.value
    for batch in batches:
        for part in slices(batch, text_col, 500):
            texts = part.column(text_col).to_pylist()
            yield part.filter(pa.array([not (t and matches(probes, t)) for t in texts], pa.bool_()))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                         item_text_col: str = "text", probe: int = 100, passage: int = 50, step: int = 8,
                         rate: float = 0.06, least: int = 30, block_bytes: int = 2 << 20) -> DataFrame:
    """The documents (all columns) that contain no item; decided row by row, without a shuffle."""
    spark = docs.sparkSession
    for items in benchmark_blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(Probes(items, min(probe, 240), passage, step, rate, least))
        docs = docs.mapInArrow(partial(_clean, shared=shared, text_col=text_col), docs.schema)
    return docs
