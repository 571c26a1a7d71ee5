"""Whole-batch text work in numpy: words, hashes and windows of many documents.

Spark hands a task Arrow batches; these helpers read the batch's byte buffer
directly, so a batch of documents is tokenised with a few array operations
instead of a Python loop over words.  Long buffers are worked through in pieces
of about ``PIECE`` bytes, so memory does not grow with the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x5851F42D4C957F2D
_MASK = (1 << 64) - 1

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
#: Odd multipliers for the places of a window.
PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that low bits depend on all input bits."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0], done = 1, 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        take = min(done, n - done)
        out[done:done + take] = out[:take] * step
        done += take
    return out


_POW = _powers(_BASE, PIECE + 1)
_INV = _powers(pow(_BASE, -1, 1 << 64), PIECE + 1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, for buffers of up to ``n`` bytes."""
    global _POW, _INV
    if n + 1 > len(_POW):
        if n > 8 * PIECE:  # one very long word: not kept
            return _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 1 << 64), n + 1)
        _POW, _INV = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 1 << 64), n + 1)
    return _POW, _INV


def byte_sums(buf: np.ndarray, lower: bool = False) -> np.ndarray:
    """Running polynomial sums; ``(s[j] - s[i]) * inv[i]`` hashes ``buf[i:j]``."""
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[buf] * powers(len(buf))[0][:len(buf)], out=out[1:])
    return out


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the row offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def _pieces(buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of the buffer into pieces that end at a row's end or before a space."""
    at, end = 0, len(buf)
    while at < end:
        stop = int(offs[np.searchsorted(offs, at + PIECE, side="right") - 1])
        if stop <= at:  # the row is longer than a piece: cut before a space
            stop = int(offs[np.searchsorted(offs, at, side="right")])
            if stop - at > PIECE:
                seen = np.flatnonzero(_IS_SPACE[buf[at + 1:at + PIECE]])
                if len(seen):
                    stop = at + 1 + int(seen[-1])
                else:
                    beyond = at + PIECE
                    while beyond < stop and not _IS_SPACE[buf[beyond]]:
                        beyond += 1
                    stop = beyond
        yield at, stop
        at = stop


def words_of(buf: np.ndarray, offs: np.ndarray, lower: bool = False
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words (runs of bytes other than space and 0x09-0x0D) of all rows.

    Returns 64-bit hash, start and end byte of each word, and for each row the
    index of its first word (one entry more than rows).
    """
    hashes, starts, ends = [], [], []
    row_start = np.zeros(len(buf) + 1, dtype=bool)
    row_start[offs] = True
    for lo, hi in _pieces(buf, offs):
        piece = buf[lo:hi]
        solid = ~_IS_SPACE[piece]
        first = solid.copy()
        first[1:] &= ~solid[:-1] | row_start[lo + 1:hi]
        last = solid.copy()
        last[:-1] &= ~solid[1:] | row_start[lo + 1:hi]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        sums = byte_sums(piece, lower)
        hashes.append(mix((sums[e] - sums[s]) * powers(len(piece))[1][s]))
        starts.append(s + lo)
        ends.append(e + lo)
    if not hashes:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offs), np.int64)
    starts = np.concatenate(starts)
    return np.concatenate(hashes), starts, np.concatenate(ends), np.searchsorted(starts, offs).astype(np.int64)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words (row borders are the caller's)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[:len(words) - n + 1] * PLACE[0]
    for k in range(1, n):
        out += words[k:len(words) - n + 1 + k] * PLACE[k]
    return mix(out)


def slices(batch: pa.RecordBatch | pa.Table, column: str, rows: int = 2000, size: int = 8 * PIECE
           ) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold a few MB (``size`` bytes); a longer row is a part of its own."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    at = 0
    while at < len(lengths):
        fits = np.searchsorted(np.cumsum(lengths[at:at + rows]), size, side="right")
        n = max(1, int(fits))
        yield batch.slice(at, n)
        at += n


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.int64).view(np.uint64)
