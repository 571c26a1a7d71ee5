"""Packed shuffles: many small numeric entries travel as a few binary blocks.

A task that makes millions of (hash, row, ...) entries sorts them by bucket and
sends one block of columns per bucket instead of one Spark row per entry.  Each
column is stored byte plane by byte plane, so the high zero bytes of ids
compress away.  A bucket is a hash range, sized by ``bucket_count`` from the
total size of the texts, so that each holds about as many entries at every
input size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "bucket int, block binary"
ARROW_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.binary())])


def bucket_count(docs: DataFrame, column: str, bytes_per_bucket: int = 4 << 20, least: int = 16) -> int:
    """Buckets for a column of texts: one for so many bytes of text."""
    total = docs.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0
    return int(max(least, min(1 << 30, -(-total // bytes_per_bucket))))


def pack(columns: Sequence[np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)


def unpack(block: bytes, dtypes: Sequence[str]) -> list[np.ndarray]:
    kinds = [np.dtype(d) for d in dtypes]
    n = len(block) // sum(k.itemsize for k in kinds)
    raw, at, out = np.frombuffer(block, np.uint8), 0, []
    for k in kinds:
        planes = raw[at:at + n * k.itemsize].reshape(k.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(k).reshape(n))
        at += n * k.itemsize
    return out


def blocks(bucket: np.ndarray, columns: Sequence[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """One (bucket, block) for each bucket that has entries."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    lows = np.concatenate([[0], cuts]) if len(bucket) else []
    highs = np.concatenate([cuts, [len(bucket)]]) if len(bucket) else []
    columns = [c[order] for c in columns]
    for lo, hi in zip(lows, highs):
        yield int(bucket[lo]), pack([c[lo:hi] for c in columns])


def to_batch(rows: Iterable[tuple[int, bytes]]) -> pa.RecordBatch:
    rows = list(rows)
    return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()),
                            pa.array([r[1] for r in rows], pa.binary())], schema=ARROW_SCHEMA)


def merged(tables: Sequence[bytes], dtypes: Sequence[str]) -> list[np.ndarray]:
    parts = [unpack(b, dtypes) for b in tables]
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, d) for d in dtypes]


def by_bucket(packed: DataFrame, task, schema: str, dtypes: Sequence[str]) -> DataFrame:
    """Run ``task(bucket, columns) -> RecordBatch`` once for each bucket's entries."""
    def run(table: pa.Table) -> pa.Table:
        columns = merged([b for b in table.column("block").to_pylist()], dtypes)
        return pa.Table.from_batches([task(columns)])

    return packed.groupBy("bucket").applyInArrow(run, schema)
