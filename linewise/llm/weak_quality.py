"""Operator 4: quality classifier from weak labels.

1. Labellers: simple rules that vote good, bad or abstain on each text.
2. Label model: expectation-maximisation estimates each labeller's vote rates on
   good and on bad texts, and the share of good texts, from the counts of vote
   patterns over all documents (at most 3^labellers rows, so they may be
   collected; no document is).
3. Scorer: the patterns' posteriors are the training labels of a linear scorer
   over hashed word shapes and words; it is fitted on at most ``sample`` (6,000)
   documents, chosen by hash, and scores every whole text.

A document is kept if its score is 0.5 or more.

Edge cases: a null or empty text has no words; the labellers vote bad, the score
is that of an empty feature list times the posterior (below 0.5).  Repeated rows
have equal scores.  Null ids keep their rows.  Extra columns are kept by
``keep_good`` and ignored elsewhere; empty tables give empty results.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.text_arrays import PIECE, PLACE, mix, slices, text_buffer, words_of

#: Features of the scorer (hashed).
DIMENSIONS = 1 << 13
LABELLERS = ("signs", "shouting", "echo", "columns", "variety", "letters", "sentences")
_GOOD, _NONE, _BAD = 1, 0, -1

_KIND = np.zeros(256, np.uint8)  # 0 other, 1 upper, 2 lower or beyond ASCII, 3 digit, 4 sign
_KIND[65:91], _KIND[97:123], _KIND[128:], _KIND[48:58] = 1, 2, 2, 3
for _c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
    _KIND[_c] = 4


def _row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def word_table(column: pa.Array):
    """Per word: hash, length, capitals, signs at the end, equal to the word before; and each row's first word."""
    buf, offs = text_buffer(column)
    words, starts, ends, first = words_of(buf, offs)
    kind = _KIND[buf]
    upper = np.append(0, np.cumsum(kind == 1, dtype=np.int64))
    sign = np.append(0, np.cumsum(kind == 4, dtype=np.int64))
    digit = np.append(0, np.cumsum(kind == 3, dtype=np.int64))
    size = ends - starts
    n_upper, n_sign, n_digit = upper[ends] - upper[starts], sign[ends] - sign[starts], digit[ends] - digit[starts]
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[first[:-1][first[:-1] < len(words)]] = False
    return words, size, n_upper, n_sign, n_digit, again, first, buf, offs, ends


def votes(table) -> np.ndarray:
    """One row of votes (good 1, none 0, bad -1) for each text; one column for each labeller."""
    words, size, n_upper, n_sign, n_digit, again, first, buf, offs, ends = table
    n = np.maximum(np.diff(first), 1)
    letters = size - n_sign - n_digit
    share = lambda mask: _row_sums(mask, first) / n
    signs = share((n_sign >= 3) & (n_sign * 4 >= size))
    shout = share((n_upper >= 2) & (n_upper * 10 >= 7 * np.maximum(letters - (letters - n_upper) // 2, 1)))
    bangs = share((n_sign >= 2) & (size > n_sign))
    echo = share(again)
    bare = share(letters == 0)
    # Distinct words of a text: sorted by row and word, counted where they change.
    row = np.repeat(np.arange(len(n)), np.diff(first))
    order = np.lexsort((words, row))
    changed = np.ones(len(words), bool)
    changed[1:] = (words[order][1:] != words[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = _row_sums(changed, first) / n
    letter_share = _row_sums(letters, first) / np.maximum(np.diff(offs), 1)
    stop = np.isin(buf[np.maximum(ends - 1, 0)], np.frombuffer(b".!?", np.uint8)) & (n_sign == 1)
    sentences = share(stop)
    empty, long_enough = np.diff(first) == 0, np.diff(first) >= 20  # shares of a few words say little

    def vote(bad, good):
        return np.where(empty | (bad & long_enough), _BAD, np.where(good, _GOOD, _NONE)).astype(np.int8)

    many = np.diff(first) >= 40
    never = np.zeros(len(n), bool)  # lacking one defect says nothing for a text: no vote
    return np.stack([
        vote(signs > 0.05, never), vote(shout > 0.08, never), vote(echo > 0.05, never), vote(bare > 0.08, never),
        vote((distinct < 0.25) & many & (np.diff(first) < 400), never),
        vote((letter_share < 0.65) | (bangs > 0.08), never),
        vote(many & (sentences < 0.015), (sentences > 0.03) & (bare < 0.03) & (signs < 0.01) & (echo < 0.02))], axis=1)


def features(table) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each word (two: its shape, the word) and their weights in the text's mean."""
    words, size, n_upper, n_sign, n_digit, again, first = table[:7]
    low = n_upper == 0
    shape = (np.minimum(size, 15) + 16 * np.minimum(n_sign, 3) + 64 * np.minimum(n_digit, 2)
             + 192 * np.where(low, 0, np.where(n_upper == 1, 1, np.where(n_upper * 2 >= size, 3, 2))) + 768 * again)
    shape = mix(shape.astype(np.uint64) * PLACE[45]) % np.uint64(DIMENSIONS // 2)
    word = mix(words ^ PLACE[46]) % np.uint64(DIMENSIONS // 2) + np.uint64(DIMENSIONS // 2)
    return shape.astype(np.int64), word.astype(np.int64)


def _pattern(rows: np.ndarray) -> np.ndarray:
    return ((rows.astype(np.int64) + 1) * 3 ** np.arange(rows.shape[1])).sum(axis=1)


def _patterns(batches):
    for batch in batches:
        for part in slices(batch, "text", size=PIECE):
            yield pa.record_batch([pa.array(_pattern(votes(word_table(part.column("text")))))], names=["pattern"])


def label_model(pattern: np.ndarray, count: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns: (posterior of good per pattern, rates[class, labeller, vote], share of good).

    Votes are independent given the class.  The start (bad votes are rare for
    good texts) names the classes.  The rate of bad votes on good texts keeps a
    strong prior at 0.002 (``20`` pseudo-texts for each text): without it, a
    defect that no other labeller sees would be taken for a habit of good texts.
    """
    votes_of = pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3  # 0 bad, 1 none, 2 good
    weight = count.astype(np.float64)
    rates = np.tile(np.array([[[0.3, 0.6, 0.1]], [[0.002, 0.598, 0.4]]]), (1, len(LABELLERS), 1))
    good = 0.8
    for _ in range(rounds):
        spread = np.arange(len(LABELLERS))
        logs = np.log(rates[:, spread, votes_of]).sum(axis=2) + np.log([[1 - good], [good]])
        posterior = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        for c, p, strength in ((0, 1 - posterior, 0.0), (1, posterior, 20.0)):
            of = [((weight * p)[:, None] * (votes_of == v)).sum(axis=0) for v in range(3)]
            n = (weight * p).sum() + 1
            bad = (of[0] + strength * n * 0.002 + 0.1) / (n * (1 + strength) + 0.3)
            rest = (of[1] + 0.1) / (of[1] + of[2] + 0.2)
            rates[c, :, 0], rates[c, :, 1], rates[c, :, 2] = bad, (1 - bad) * rest, (1 - bad) * (1 - rest)
        good = float(np.clip((weight * posterior).sum() / weight.sum(), 0.01, 0.99))
    return posterior, rates, good


def _examples(batches):
    """pattern, feature indices and values of the sampled texts."""
    for batch in batches:
        for part in slices(batch, "text", size=PIECE):
            table = word_table(part.column("text"))
            shape, word = features(table)
            first = table[6]
            index, value = [], []
            for lo, hi in zip(first[:-1], first[1:]):
                at, times = np.unique(np.concatenate([shape[lo:hi], word[lo:hi]]), return_counts=True)
                index.append(at.astype(np.int32))
                value.append((times / max(1, hi - lo)).astype(np.float32))
            yield pa.record_batch([pa.array(_pattern(votes(table))), pa.array(index, pa.list_(pa.int32())),
                                   pa.array(value, pa.list_(pa.float32()))], names=["pattern", "index", "value"])


def fit_linear(lengths: np.ndarray, at: np.ndarray, x: np.ndarray, target: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights (the last is the constant) of a logistic scorer for soft labels; both classes weigh the same.

    The texts' feature indices and values stand one after another, ``lengths`` of each text.
    """
    row, at = np.repeat(np.arange(len(lengths)), lengths), at.astype(np.int64)
    share = float(np.clip(target.mean(), 0.02, 0.98)) if len(target) else 0.5
    balance = target / (2 * share) + (1 - target) / (2 * (1 - share))
    w, m, v = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    for t in range(1, rounds + 1):  # Adam: mean features differ by orders of size
        z = np.bincount(row, x * w[at], len(target)) + w[-1]
        error = balance * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) / max(1, len(target))
        g = np.append(np.bincount(at, x * error[row], DIMENSIONS), error.sum()) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.3 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w


class QualityModel:
    """The scorer's weights, the labellers' estimated rates and each pattern's posterior."""

    def __init__(self, weights, pattern, posterior, rates, share):
        self.weights, self.rates, self.share = weights, rates, share
        self.posterior = dict(zip(pattern.tolist(), posterior.tolist()))

    def score(self, table) -> np.ndarray:
        shape, word = features(table)
        first = table[6]
        z = _row_sums(self.weights[shape] + self.weights[word], first) / np.maximum(np.diff(first), 1)
        # A text of few words leans on the share of good texts instead of its own mean.
        n = np.diff(first)
        prior = np.log(np.clip(self.share, 0.05, 0.95) / (1 - np.clip(self.share, 0.05, 0.95)))
        z = (n * (z + self.weights[-1]) + 20 * prior) / (n + 20)
        score = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        return np.where(np.diff(first) == 0, 0.0, score)


def fit_quality(docs: DataFrame, *, text_col: str = "text", sample: int = 6000) -> QualityModel:
    rows = docs.select(F.col(text_col).alias("text"))
    counts = rows.mapInArrow(_patterns, "pattern long").groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).toPandas()
    pattern, count = counts["pattern"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    if not len(pattern):
        return QualityModel(np.zeros(DIMENSIONS + 1), pattern, count.astype(float), None, 0.5)
    posterior, rates, share = label_model(pattern, count)
    # The sample: a hash range of about ``sample`` texts, cut to ``sample`` rows.
    key = F.pmod(F.xxhash64("text", F.lit(4)), F.lit(1 << 30))
    top = int(min(1 << 30, 1.2 * sample / count.sum() * (1 << 30) + 1))
    chosen = rows.where(F.col("text").isNotNull() & (F.octet_length("text") <= 1 << 20)).where(key < top).orderBy(key).limit(sample)
    fit = chosen.mapInArrow(_examples, "pattern long, index array<int>, value array<float>").toArrow().combine_chunks()
    told = dict(zip(pattern.tolist(), posterior.tolist()))
    target = np.array([told[p] for p in fit.column("pattern").to_pylist()], np.float64)
    flat = [pc.list_flatten(fit.column(c)).to_numpy() for c in ("index", "value")]
    weights = fit_linear(pc.list_value_length(fit.column("index")).to_numpy(), *flat, target)
    return QualityModel(weights, pattern, posterior, rates, share)


def _scored(batches, shared):
    model = shared.value
    for batch in batches:
        for part in slices(batch, "text", size=PIECE):
            table = word_table(part.column("text"))
            given = [model.posterior.get(p, 0.5) for p in _pattern(votes(table)).tolist()]
            score = model.score(table)
            yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(table[6])), pa.array(given, pa.float64()),
                                   pa.array(score), pa.array(score >= 0.5)],
                                  names=["doc_id", "n_words", "weak_label", "score", "kept"])


def score_quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = 6000) -> DataFrame:
    """doc_id, n_words, weak_label (posterior of the votes), score, kept of every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, text_col=text_col, sample=sample))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(partial(_scored, shared=model), "doc_id long, n_words long, weak_label double, score double, kept boolean")


def _good(batches, shared, text_col):
    model = shared.value
    for batch in batches:
        for part in slices(batch, text_col, size=PIECE):
            yield part.filter(pa.array(model.score(word_table(part.column(text_col))) >= 0.5))


def keep_good(docs: DataFrame, *, text_col: str = "text", sample: int = 6000) -> DataFrame:
    """The documents (all columns) that the scorer keeps."""
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, text_col=text_col, sample=sample))
    return docs.mapInArrow(partial(_good, shared=model, text_col=text_col), docs.schema)
