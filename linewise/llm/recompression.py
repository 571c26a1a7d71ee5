"""Operator 9: substring dedup by recompression of the word sequence.

Every word gets a name (a 64-bit hash: the same word has the same name in every
task, so a round of naming needs no exchange).  A round gives each name one of
two sides and joins each left name with a right name that follows it into a new
name.  Whether two neighbours join depends on those two names only, so equal
passages get equal names except next to their ends, and equal neighbours (runs)
never join with each other and keep one name per word.  After two rounds a name
covers 1 to 4 words and is decided by the words from 2 before its first to 3
after it.

A window of 13 words therefore has names inside that are decided by the window
alone; the smallest of those that begin at its third to eighth word is its
anchor.  Windows that share this high-level name and the 8 words around it are
compared further (``repeats``); the rest of the corpus is done after one pass.

Edge cases: a null or empty text has no words.  A null doc_id counts as larger
than all others; rows with equal doc_ids do not remove each other's words.
Repeated rows give equal results.  Extra columns are ignored; empty tables give
empty results.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.repeats import NO_ID, covered, keyed, repeated_starts, row_key, span_hash, with_spans
from linewise.llm.text_arrays import PLACE, mix, powers, slices, text_buffer, words_of

_STEP = 1 << 18
_NONE = np.uint64((1 << 64) - 1)


def _side(names: np.ndarray, round_no: int) -> np.ndarray:
    return (mix(names ^ PLACE[50 + round_no]) & np.uint64(1)).astype(bool)


def names_after_two_rounds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, names): where a second-round name begins, and the name there."""
    n = len(words)
    right = _side(words, 0)
    begins = np.ones(n + 3, bool)  # first-round names; the places after the end begin nothing to join
    begins[1:n] = right[:-1] | ~right[1:]
    first = words * PLACE[0]
    pair = ~begins[1:n]
    first[:-1][pair] += words[1:][pair] * PLACE[1]
    first = mix(first)
    side = np.zeros(n + 3, bool)
    side[:n] = _side(first, 1)
    before = np.ones(n, bool)  # side of the first-round name that ends before this one
    before[1:] = np.where(begins[:n - 1], side[:n - 1], np.append(True, side[:n - 2]) if n > 1 else side[:0])
    starts = begins[:n] & (before | ~side[:n])
    starts[:1] = True
    after = np.arange(n) + np.where(begins[1:n + 1], 1, 2)
    inside = np.minimum(after, n - 1)
    joined = (after < n) & ~starts[inside]
    names = first * PLACE[2] + np.where(joined, first[inside] * PLACE[3], np.uint64(0))
    return starts, mix(names)


def anchors(words: np.ndarray, width: int, reach: tuple[int, int]) -> np.ndarray:
    """For each window start the place of its anchor: the smallest name that begins in ``reach``."""
    starts, names = names_after_two_rounds(words)
    value = np.where(starts, names, _NONE)
    m = len(words) - width + 1
    best = value[reach[0]:reach[0] + m].copy()
    place = np.zeros(m, np.int64)
    for k in range(1, reach[1] - reach[0] + 1):
        here = value[reach[0] + k:reach[0] + k + m]
        better = here < best
        best[better] = here[better]
        place[better] = k
    return np.arange(m) + reach[0] + place


def _word_sums(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = powers(len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[:len(words)], out=sums[1:])
    return sums, inverse


def word_runs(column: pa.Array, width: int):
    """Runs of windows with the same anchor: row, first start, starts, anchor offset, core and context hash."""
    reach = (2, width - 6)
    buf, offs = text_buffer(column)
    words, _, _, first = words_of(buf, offs)
    out = []
    for at in range(0, max(0, len(words) - width + 1), _STEP):
        piece = words[at:at + _STEP + width - 1]
        place = anchors(piece, width, reach)
        start = np.arange(len(place)) + at
        row = np.searchsorted(first, start, side="right") - 1
        inside = start + width <= first[row + 1]
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
        sums, inverse = _word_sums(piece)
        # A row's windows come first in it, so valid starts of a run are consecutive.
        begin = np.flatnonzero(new & inside)
        stop = np.flatnonzero((np.append(new[1:], True) | np.append(~inside[1:], True)) & inside)
        a = place[begin]
        core = span_hash(sums, inverse, a - 2, a + 6)
        context = span_hash(sums, inverse, begin, stop + width) ^ mix((a - begin).astype(np.uint64))
        r = row[begin]
        out.append((r, begin + at - first[r], stop - begin + 1, a - begin, core, context))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out))


def _windows(text: bytes, lo: np.ndarray, n: np.ndarray, back: np.ndarray, width: int):
    """The single windows of the runs."""
    words = words_of(*text_buffer(pa.array([text], pa.binary())))[0]
    sums, inverse = _word_sums(words)
    start = np.repeat(lo - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
    key = span_hash(sums, inverse, start, start + width)
    one = np.ones(len(start), np.int64)
    return key, key, start, one, one * 0


def _apply(batches, width: int):
    for batch in batches:
        for part in slices(batch, "text", 500):
            texts, out = part.column("text"), []
            spans_of = part.column("spans").to_pylist()
            buf, offs = text_buffer(texts)
            _, starts, ends, first = words_of(buf, offs)
            raw = buf.tobytes()
            for r, spans in enumerate(spans_of):
                s, e = starts[first[r]:first[r + 1]], ends[first[r]:first[r + 1]]
                gone = np.zeros(len(s), bool)
                if spans:
                    gone = covered(np.array([x["lo"] for x in spans]), np.array([x["n"] for x in spans]), width, len(s))
                kept = b" ".join(raw[i:j] for i, j in zip(s[~gone].tolist(), e[~gone].tolist()))
                out.append((len(s), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            cols = list(zip(*out))
            yield pa.record_batch([part.column("doc"), part.column("tag"), pa.array(cols[0], pa.int64()),
                                   pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                                   pa.array(cols[3], pa.string())],
                                  names=["doc", "tag", "n_words", "n_removed", "kept_sha256", "kept_text"])


_RESULT = "doc long, tag long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def word_starts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 13) -> DataFrame:
    """doc, tag, lo, n: starts of the windows that also start in a document with a smaller id."""
    if width < 11:
        raise ValueError("a window needs 11 words or more to hold names decided by itself")
    return repeated_starts(keyed(docs, id_col, text_col), partial(word_runs, width=width),
                           [partial(_windows, width=width)], earlier=True, bytes_per_bucket=4 << 20)


def dedup_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text (the words left, one space between) of each row."""
    rows = keyed(docs, id_col, text_col)
    spans = word_starts(docs, id_col=id_col, text_col=text_col, width=width)
    done = with_spans(rows, spans, ["lo", "n"], only=False).mapInArrow(partial(_apply, width=width), _RESULT)
    doc_id = F.when(F.col("doc") != NO_ID, F.col("doc"))
    return done.select(doc_id.alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept_text")


def _rewrite(batches, width: int, text_col: str, size_col: str | None):
    for batch in batches:
        rows = pa.RecordBatch.from_struct_array(pa.concat_arrays([batch.column("row")]))
        at = 0
        for table in slices(rows, text_col, 500):
            spans_of = batch.column("spans").slice(at, len(table)).to_pylist()
            at += len(table)
            texts = table.column(text_col).to_pylist()
            buf, offs = text_buffer(table.column(text_col))
            _, starts, ends, first = words_of(buf, offs)
            sizes = table.column(size_col).to_pylist() if size_col else None
            for r, spans in enumerate(spans_of):
                if spans:
                    s, e = starts[first[r]:first[r + 1]], ends[first[r]:first[r + 1]]
                    gone = covered(np.array([x["lo"] for x in spans]), np.array([x["n"] for x in spans]), width, len(s))
                    raw = buf[offs[r]:offs[r + 1]].tobytes()
                    s, e = s[~gone] - offs[r], e[~gone] - offs[r]
                    texts[r] = b" ".join(raw[i:j] for i, j in zip(s.tolist(), e.tolist())).decode("utf-8", "replace")
                    if size_col:
                        sizes[r] = len(texts[r])
            for name, values in ((text_col, texts), (size_col, sizes)):
                if name:
                    place = table.schema.get_field_index(name)
                    table = table.set_column(place, name, pa.array(values, table.schema.field(place).type))
            yield table


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    size_col: str | None = "n_chars", width: int = 13) -> DataFrame:
    """The documents (all rows, all columns) without the repeated words.

    A text that loses words keeps the others with one space between; other texts
    stay as they are.  ``size_col``, where the table has it, becomes the new
    length of a text that changed.
    """
    spans = word_starts(docs, id_col=id_col, text_col=text_col, width=width)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *row_key(id_col, text_col))
    spanned = with_spans(rows, spans, ["lo", "n"], only=False).select("row", "spans")
    size_col = size_col if size_col in docs.columns else None
    return spanned.mapInArrow(partial(_rewrite, width=width, text_col=text_col, size_col=size_col), docs.schema)
