"""What the Python side of the pipeline's first two stages holds at once, for one Arrow batch of 8 MB of text."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from linewise.llm import jaccard_join, weak_quality
from linewise.llm.text_arrays import slices

MB = 1 << 20


def _batch(rows: int = 4000, words: int = 300) -> pa.RecordBatch:
    rng = random.Random(5)
    known = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(5000)]
    texts = [" ".join(rng.choices(known, k=words)) + "." for _ in range(rows)]
    ids = pa.array(range(rows), pa.int64())
    return pa.record_batch([ids, ids, pa.array(texts)], names=["doc_id", "text_key", "text"])


BATCH = _batch()


def _model():
    return weak_quality.QualityModel(np.zeros(weak_quality.DIMENSIONS + 1), np.zeros(1, int), np.zeros(1), None, 0.5)


def _peak(work) -> float:
    tracemalloc.start()
    try:
        for _ in work:
            pass
        return tracemalloc.get_traced_memory()[1] / MB
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("work", [
    lambda: weak_quality._patterns([BATCH]),
    lambda: weak_quality._examples([BATCH]),
    lambda: weak_quality._scored([BATCH], SimpleNamespace(value=_model())),
    lambda: weak_quality._good([BATCH], SimpleNamespace(value=_model()), "text"),
])
def test_quality_works_on_small_parts(work):
    assert _peak(work()) < 60


def test_shingles_are_held_once():
    order = SimpleNamespace(value=np.zeros(0, np.uint64))
    assert _peak(jaccard_join._measure([BATCH], 5)) < 45
    assert _peak(jaccard_join._prefixes([BATCH], 5, 4, 5, 16, order)) < 30


def test_parts_keep_every_row():
    texts = [None, "", "ä" * 5, "x" * 40, None, "y" * 3, "z" * 12]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    parts = list(slices(batch.slice(1), "text", size=12))
    assert [p.column("doc_id").to_pylist() for p in parts] == [[1, 2], [3], [4, 5], [6]]
    table = pa.Table.from_batches([batch, batch])
    assert sum((p.column("text").to_pylist() for p in slices(table, "text", size=12)), []) == texts + texts


def test_tokens_of_several_sets_are_counted():
    sets = [["a b c d e f", "a b c d e g", "x"], ["x y"], ["a b c d e", "b c d e f"], [None, ""]]
    for texts in sets:
        ids = pa.array(range(len(texts)), pa.int64())
        batch = pa.record_batch([ids, ids, pa.array(texts, pa.string())], names=["doc_id", "text_key", "text"])
        held = Counter(t for s in jaccard_join.shingle_sets(batch.column("text"), 5) for t in s.tolist())
        told = pa.Table.from_batches(jaccard_join._measure([batch], 5)).to_pylist()
        assert [r["kind"] for r in told[:len(texts)]] == [0] * len(texts)
        assert ({r["node"] % (1 << 64): r["n"] for r in told[len(texts):]}
                == {t: n for t, n in held.items() if n > 1})
