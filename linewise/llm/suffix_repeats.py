"""Operator 7: repeated byte strings of ``width`` (400) bytes, across and inside documents.

Shards (Arrow batches of documents) order their own suffixes by a prefix, and
the shards' orders are merged in rounds.  A round holds blocks of suffixes that
agree on a common prefix; it splits them by a longer one and sets aside what is
settled: suffixes alone in their block (their common prefix with any other is
shorter than a window) and blocks that agree on all of it (repeated intervals).
Suffixes are never sorted again as a whole.

* Only suffixes at anchors take part: the smallest 24-byte gram (by hash) of the
  256 that begin in the window's first 256 bytes.  So one suffix in about 128
  stands for the windows around it.
* Rounds: 145 bytes that all windows with that anchor share; then the bytes of
  all windows of a run at once (settled: repeated); then cells of 16 starts (385
  shared bytes, then the whole cell); then single windows of 400 bytes.

Blocks are found by 64-bit hashes of these strings instead of by moving an
interleave vector byte by byte: that takes up to 400 rounds over all suffixes of
the corpus (see the README).

Edge cases: a null or empty text has no bytes and nothing to remove.  Repeated
rows are occurrences of their own, so all of a repeated row of 400 bytes or more
goes.  Null ids keep their rows.  Extra columns are ignored; empty tables give
empty results.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.repeats import NO_ID, covered, keyed, repeated_starts, span_hash, with_spans
from linewise.llm.text_arrays import byte_sums, mix, powers, slices, text_buffer

_STEP = 1 << 19
_GRAM = 24
_REACH = 256
_CELL = 16
_PLACES = np.uint64((1 << 21) - 1)


def byte_anchors(sums: np.ndarray, inverse: np.ndarray, starts: int) -> np.ndarray:
    """For the first ``starts`` places: the place of the smallest gram among the next 256 (the last of equals)."""
    m = starts + _REACH - 1
    gram = mix((sums[_GRAM:_GRAM + m] - sums[:m]) * inverse[:m])
    least = (gram & ~_PLACES) | (_PLACES - np.arange(m, dtype=np.uint64))
    span = 1
    while span < _REACH:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return (_PLACES - (least[:starts] & _PLACES)).astype(np.int64)


def byte_runs(column: pa.Array, width: int):
    """Runs of windows with the same anchor: row, first start, starts, anchor offset, core and context hash."""
    buf, offs = text_buffer(column)
    out = []
    for at in range(0, max(0, len(buf) - width + 1), _STEP):
        piece = buf[at:at + _STEP + width - 1]
        m = len(piece) - width + 1
        sums, inverse = byte_sums(piece), powers(len(piece))[1]
        place = byte_anchors(sums, inverse, m)
        ends = offs[(offs > at) & (offs < at + m + width)] - at
        inside = np.ones(m, bool)
        for e in ends:  # starts whose window would cross a row's end
            inside[max(0, e - width + 1):min(m, e)] = False
        new = np.ones(m, bool)
        new[1:] = place[1:] != place[:-1]
        new[ends[ends < m]] = True
        begin = np.flatnonzero(new & inside | inside & np.append(True, ~inside[:-1]))
        stop = np.flatnonzero((np.append(new[1:], True) | np.append(~inside[1:], True)) & inside)
        a = place[begin]
        row = np.searchsorted(offs, begin + at, side="right") - 1
        core = span_hash(sums, inverse, a, a + width - _REACH + 1)
        context = span_hash(sums, inverse, begin, stop + width) ^ mix((a - begin).astype(np.uint64))
        out.append((row, begin + at - offs[row], stop - begin + 1, a - begin, core, context))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out))


def _span_keys(raw: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hashes of byte spans; a long text is worked through in pieces."""
    out = np.zeros(len(lo), np.uint64)
    if len(raw) <= 4 * _STEP:
        return span_hash(byte_sums(raw), powers(len(raw))[1], lo, hi) if len(lo) else out
    for group in np.unique(lo // _STEP):
        at = np.flatnonzero(lo // _STEP == group)
        base = int(group) * _STEP
        piece = raw[base:int(hi[at].max())]
        out[at] = span_hash(byte_sums(piece), powers(len(piece))[1], lo[at] - base, hi[at] - base)
    return out


def _cells(text: bytes, lo: np.ndarray, n: np.ndarray, back: np.ndarray, width: int):
    """Cells of 16 starts, counted back from the anchor."""
    raw = np.frombuffer(text, np.uint8)
    near, far = (back - n + 1) // _CELL, back // _CELL
    count = far - near + 1
    run = np.repeat(np.arange(len(lo)), count)
    c = np.arange(count.sum()) - np.repeat(np.append(0, np.cumsum(count)[:-1]), count) + near[run]
    anchor = (lo + back)[run]
    first = np.maximum(lo[run], anchor - _CELL * c - _CELL + 1)
    last = np.minimum((lo + n - 1)[run], anchor - _CELL * c)
    shared = anchor - _CELL * c
    core = _span_keys(raw, shared, shared - _CELL + 1 + width)
    context = _span_keys(raw, first, last + width) ^ mix((anchor - first).astype(np.uint64))
    return core, context, first, last - first + 1, first * 0


def _windows(text: bytes, lo: np.ndarray, n: np.ndarray, back: np.ndarray, width: int):
    raw = np.frombuffer(text, np.uint8)
    start = np.repeat(lo - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
    key = _span_keys(raw, start, start + width)
    return key, key, start, np.ones(len(start), np.int64), start * 0


def _apply(batches, width: int):
    for batch in batches:
        for part in slices(batch, "text", 500):
            spans_of, out = part.column("spans").to_pylist(), []
            buf, offs = text_buffer(part.column("text"))
            for r, spans in enumerate(spans_of):
                raw = buf[offs[r]:offs[r + 1]]
                kept, runs, gone = raw, 0, 0
                if spans:
                    mask = covered(np.array([x["lo"] for x in spans]), np.array([x["n"] for x in spans]), width, len(raw))
                    kept, gone = raw[~mask], int(mask.sum())
                    runs = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                kept = kept.tobytes()
                out.append((len(raw), gone, runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            cols = list(zip(*out))
            yield pa.record_batch([part.column("doc"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                   pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()),
                                   pa.array(cols[4], pa.string())],
                                  names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])


def byte_starts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 400) -> DataFrame:
    """doc, tag, lo, n: ranges of byte offsets at which a repeated string of ``width`` bytes starts."""
    if width < _REACH + _GRAM + _CELL:
        raise ValueError(f"width must be at least {_REACH + _GRAM + _CELL}")
    return repeated_starts(keyed(docs, id_col, text_col), partial(byte_runs, width=width),
                           [partial(_cells, width=width), partial(_windows, width=width)],
                           earlier=False, bytes_per_bucket=16 << 20)


def dedup_bytes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept_text of each row.

    ``kept_text`` is what is left; bytes of a character that was cut are replacement characters in it.
    """
    rows = keyed(docs, id_col, text_col)
    spans = byte_starts(docs, id_col=id_col, text_col=text_col, width=width)
    done = with_spans(rows, spans, ["lo", "n"], only=False).mapInArrow(
        partial(_apply, width=width), "doc long, n_bytes long, n_removed long, n_spans long, "
        "kept_sha256 string, kept_text string")
    return done.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
                       "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
