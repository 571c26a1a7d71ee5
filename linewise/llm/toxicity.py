"""Operator 8: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a lexicon (word beginnings that training texts
marked toxic use more often; hits, strongest hit, hits near a second-person word),
second-person words, capitals, punctuation, digits, obfuscation (signs or digits
inside words; the lexicon is also looked up with them undone), word lengths.

Rows with crc32(doc_id as text) mod 5 = 0 are held out.  Of the others at most
``sample`` (20,000) labelled rows, chosen by hash, are used: remainders 1 to 3
give the lexicon and the trees, remainder 4 the calibration.  Ids, sources,
languages and labels are never features.

Edge cases: a null or empty text has all features 0 and gets that score.  Null
ids are not held out and not trained on.  Repeated rows score alike.  An id whose
labels disagree is not trained on; of several texts with one id, the one with the
smallest hash is.  Documents without labels are scored as all others.  With no labels, or of one class only,
the score is that class's share (0 for none).  Extra columns are ignored; empty
tables give empty results.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.tables import stored
from linewise.llm.text_arrays import byte_sums, mix, powers, signed, slices, text_buffer, words_of

# Second-person words (English, German, French, Spanish).
SECOND_PERSON = ("you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "toi", "te",
                 "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "usted", "ustedes", "vosotros")
# Letters that digits and signs stand for in obfuscated words.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
FEATURES = ("log_words", "hits", "density", "strongest", "mean_strength", "near_you", "you", "capitals", "capital_words",
            "exclamations", "signs", "digits", "obfuscated", "word_length")
LEXICON = 4096
_NEAR = 6

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_UNDO = np.arange(256, dtype=np.uint8)
for _k, _v in STANDS_FOR.items():
    _UNDO[ord(_k)] = ord(_v)
_PREFIXES = (4, 5, 6)


def _sum_rows(values, first):
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def plain_words(buf: np.ndarray, offs: np.ndarray):
    """Bytes without signs, with obfuscating digits undone; row offsets in them."""
    # A sign that stands for a letter counts only inside a word: the last byte of one is punctuation.
    undone = _UNDO[buf]
    inner = np.zeros(len(buf), bool)
    if len(buf) > 1:
        inner[:-1] = ~_SPACE[buf[:-1]] & _LETTER[_UNDO[buf[1:]]]
    keep = _SPACE[buf] | _LETTER[buf] | _DIGIT[buf] | (_LETTER[undone] & inner)
    kept_before = np.append(0, np.cumsum(keep))
    return undone[keep], kept_before[offs]


def stems(buf: np.ndarray, offs: np.ndarray):
    """Per word the hashes of its first 4, 5, 6 bytes and of the whole (lower case), and each row's first word."""
    plain, at = plain_words(buf, offs)
    words, starts, ends, first = words_of(plain, at, lower=True)
    out = [words]
    # Prefix hashes, so many words at a time.
    for n in _PREFIXES:
        h = np.zeros(len(words), np.uint64)
        for lo in range(0, len(words), 1 << 16):
            s = starts[lo:lo + (1 << 16)]
            stop = np.minimum(s + n, ends[lo:lo + (1 << 16)])
            base = int(s[0])
            piece = plain[base:int(stop.max())]
            sums = byte_sums(piece, lower=True)
            h[lo:lo + (1 << 16)] = mix((sums[stop - base] - sums[s - base]) * powers(len(piece))[1][s - base]
                                       ^ np.uint64(0x517CC1B727220A95 + n))
        out.append(h)
    return np.stack(out, axis=1) if len(words) else np.zeros((0, 1 + len(_PREFIXES)), np.uint64), first


_YOU = np.sort(words_of(*text_buffer(pa.array([" ".join(SECOND_PERSON)])), lower=True)[0])


def _is_in(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(ordered):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values, at


def features(column: pa.Array, lexicon: np.ndarray, strength: np.ndarray) -> np.ndarray:
    buf, offs = text_buffer(column)
    parts, first = stems(buf, offs)
    n = np.maximum(np.diff(first), 1)
    best = np.zeros(len(parts))
    for k in range(parts.shape[1]):
        hit, at = _is_in(parts[:, k], lexicon)
        best = np.maximum(best, np.where(hit, strength[at] if len(strength) else 0.0, 0.0))
    hit = best > 0
    you = _is_in(parts[:, 0], _YOU)[0] if len(parts) else np.zeros(0, bool)
    near = np.zeros(len(parts), bool)
    seen = np.append(0, np.cumsum(you))
    place = np.arange(len(parts))
    row = np.repeat(np.arange(len(n)), np.diff(first))
    lo, hi = np.maximum(first[:-1][row], place - _NEAR), np.minimum(first[1:][row], place + _NEAR + 1)
    near = hit & (seen[hi] - seen[lo] > 0) if len(parts) else near
    strongest = np.zeros(len(n))
    np.maximum.at(strongest, row, best)
    letter, digit, space = _LETTER[buf], _DIGIT[buf], _SPACE[buf]
    sign = ~letter & ~digit & ~space
    upper = (buf >= 65) & (buf <= 90)
    odd = np.zeros(len(buf), bool)
    if len(buf) > 2:
        odd[1:-1] = (sign | digit)[1:-1] & letter[:-2] & letter[2:]
    size = np.maximum(np.diff(offs), 1)
    shout = np.zeros(len(buf), bool)
    shout[1:] = upper[1:] & upper[:-1]
    hits = _sum_rows(hit, first)
    cols = [np.log1p(np.diff(first)), hits, hits / n, strongest, _sum_rows(best, first) / n, _sum_rows(near, first),
            _sum_rows(you, first) / n, _sum_rows(upper, offs) / size, _sum_rows(shout, offs) / size,
            _sum_rows(buf == 33, offs) / size, _sum_rows(sign, offs) / size, _sum_rows(digit, offs) / size,
            _sum_rows(odd, offs) / n, _sum_rows(letter, offs) / n]
    return np.stack(cols, axis=1)


class Boosted:
    """Gradient-boosted trees of depth 3 for the logistic loss, on binned features."""

    def __init__(self, rounds: int = 60, rate: float = 0.2, bins: int = 32, least: int = 10):
        self.rounds, self.rate, self.bins, self.least = rounds, rate, bins, least
        self.trees, self.start = [], 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        # Rare features are 0 at most quantiles: a cut above 0 as well.
        edges = [np.unique(np.append(e, [0.0])) for e in edges]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        z = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-z))
            tree = self._tree(binned, edges, y - p, p * (1 - p), np.arange(len(y)), 3)
            self.trees.append(tree)
            z += self._apply(tree, x)
        return self

    def _tree(self, binned, edges, g, h, at, depth):
        leaf = self.rate * g[at].sum() / (h[at].sum() + 1.0)
        best = (1e-6, None, None)
        if depth and len(at) >= 2 * self.least:
            total_g, total_h = g[at].sum(), h[at].sum()
            for j, e in enumerate(edges):
                k = len(e) + 1
                sg = np.cumsum(np.bincount(binned[at, j], g[at], k))[:-1]
                sh = np.cumsum(np.bincount(binned[at, j], h[at], k))[:-1]
                sn = np.cumsum(np.bincount(binned[at, j], minlength=k))[:-1]
                gain = sg ** 2 / (sh + 1) + (total_g - sg) ** 2 / (total_h - sh + 1) - total_g ** 2 / (total_h + 1)
                gain[(sn < self.least) | (len(at) - sn < self.least)] = 0
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), j, int(gain.argmax()))
        if best[1] is None:
            return float(leaf)
        _, j, cut = best
        left = binned[at, j] <= cut
        return (j, float(edges[j][cut]), self._tree(binned, edges, g, h, at[left], depth - 1),
                self._tree(binned, edges, g, h, at[~left], depth - 1))

    def _apply(self, tree, x):
        if isinstance(tree, float):
            return np.full(len(x), tree)
        j, cut, low, high = tree
        return np.where(x[:, j] <= cut, self._apply(low, x), self._apply(high, x))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((self._apply(t, x) for t in self.trees), np.zeros(len(x)))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (points, values) of the non-decreasing fit."""
    order = np.argsort(x, kind="stable")
    blocks = []  # value, weight, first, last
    for a, b in zip(x[order], y[order]):
        blocks.append([b, 1.0, a, a])
        while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
            v, w, _, last = blocks.pop()
            u = blocks[-1]
            u[0], u[1], u[3] = (u[0] * u[1] + v * w) / (u[1] + w), u[1] + w, last
    points = np.array([p for b in blocks for p in (b[2], b[3])])
    return points, np.repeat([b[0] for b in blocks], 2)


class ToxicityModel:
    def __init__(self, lexicon, strength, trees=None, points=None, values=None, constant=0.0):
        self.lexicon, self.strength, self.trees = lexicon, strength, trees
        self.points, self.values, self.constant = points, values, constant

    def score(self, column: pa.Array) -> np.ndarray:
        if self.trees is None:
            return np.full(len(column), self.constant)
        raw = self.trees.raw(features(column, self.lexicon, self.strength))
        calibrated = np.interp(raw, self.points, self.values)
        return 0.99 * calibrated + 0.01 / (1 + np.exp(-np.clip(raw, -50, 50)))  # keeps the order inside flat steps


def _count_stems(batches):
    """Documents that have a stem, toxic and other, counted within a batch."""
    for batch in batches:
        for part in slices(batch, "text"):
            parts, first = stems(*text_buffer(part.column("text")))
            toxic = np.asarray(part.column("toxic").to_pylist(), np.int64)
            found, label = [], []
            for r, (lo, hi) in enumerate(zip(first[:-1], first[1:])):
                own = np.unique(parts[lo:hi])
                found.append(own)
                label.append(np.full(len(own), toxic[r]))
            if found:
                stem, at = np.unique(np.concatenate(found), return_inverse=True)
                pos = np.bincount(at, np.concatenate(label), len(stem)).astype(np.int64)
                n = np.bincount(at, minlength=len(stem)).astype(np.int64)
                yield pa.record_batch([pa.array(signed(stem)), pa.array(pos), pa.array(n)], names=["stem", "pos", "n"])


def _featured(batches, shared):
    lexicon, strength = shared.value
    for batch in batches:
        for part in slices(batch, "text"):
            yield pa.record_batch([part.column("id"), part.column("toxic"), part.column("fold"),
                                   pa.array(list(features(part.column("text"), lexicon, strength)), pa.list_(pa.float64()))],
                                  names=["id", "toxic", "fold", "x"])


def fold(id_col: str):
    return (F.crc32(F.col(id_col).cast("string").cast("binary")) % 5).cast("int")


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", sample: int = 20_000) -> ToxicityModel:
    spark = docs.sparkSession
    told = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
            .where(F.col("label").isin(0, 1) & F.col("id").isNotNull()).withColumn("fold", fold("id")).where("fold != 0"))
    agreed = (told.groupBy("id", "fold").agg(F.min("label").alias("toxic"), F.max("label").alias("most"))
              .where("toxic = most").drop("most"))
    chosen = agreed.orderBy(F.xxhash64("id"), "id").limit(sample)
    # At most ``sample`` labels, and one text of each: a proven bound.
    labelled = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.octet_length("text"))).alias("text")
    rows = stored(labelled.join(F.broadcast(chosen), "id").groupBy("id", "toxic", "fold").agg(one), "labelled")
    train = rows.where("fold != 4")
    per = train.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("pos")).first()
    n, pos = per["n"] or 0, per["pos"] or 0
    none = np.zeros(0, np.uint64)
    if not 0 < pos < n:
        return ToxicityModel(none, np.zeros(0), constant=pos / n if n else 0.0)
    counts = (train.select("text", "toxic").mapInArrow(_count_stems, "stem long, pos long, n long")
              .groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")))
    odds = F.log((F.col("pos") + 0.5) / (pos + 1.0) / ((F.col("n") - F.col("pos") + 0.5) / (n - pos + 1.0)))
    lexicon = (counts.where("pos >= 5").withColumn("odds", odds).where("odds > 3")
               .orderBy(F.desc("odds"), "stem").limit(LEXICON).toPandas())
    stem = lexicon["stem"].to_numpy(np.int64).view(np.uint64) if len(lexicon) else none
    order = np.argsort(stem)
    words = (stem[order], lexicon["odds"].to_numpy(np.float64)[order])
    shared = spark.sparkContext.broadcast(words)
    data = rows.mapInArrow(partial(_featured, shared=shared), "id long, toxic int, fold int, x array<double>").toArrow()
    data = data.combine_chunks().sort_by("id")  # the sums of a rerun run in the same order
    y, part = data.column("toxic").to_numpy().astype(np.float64), data.column("fold").to_numpy()
    x = data.column("x").combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    trees = Boosted().fit(x[part != 4], y[part != 4])
    held = part == 4 if len(set(y[part == 4])) == 2 else part != 4
    points, values = isotonic(trees.raw(x[held]), y[held])
    return ToxicityModel(*words, trees, points, values)


def _scored(batches, shared):
    model = shared.value
    for batch in batches:
        for part in slices(batch, "text"):
            score = model.score(part.column("text"))
            yield pa.record_batch([part.column("doc_id"), part.column("held_out"), pa.array(score),
                                   pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, id_col=id_col, text_col=text_col, **options))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold(id_col) == 0, F.lit(False)).alias("held_out"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(partial(_scored, shared=model), "doc_id long, held_out boolean, score double, predicted int")
