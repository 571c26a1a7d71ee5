import math
import re
from collections import Counter

from compare import compare, duck
from conftest import SF01
from hypothesis import given, settings
from hypothesis import strategies as st

from linewise.llm import queries
from linewise.llm.oracle import ORACLE
from linewise.llm.ranked_search import _Item, _Segment, ranked_search, term_counts

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10, b=75):
    counts = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n, total = len(counts), sum(c.total() for _, c in counts)
    out = []
    for item, text in set(items):
        scores = []
        for d, c in counts:
            m = 100 - b + (b * c.total() * n) // total
            score = 0
            for t in terms(text):
                df = sum(t in x for _, x in counts)
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                score += w * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_query_equals_sql(spark):
    ok, why = compare(queries.op12_ranked_search(spark, SF01), duck(SF01), ORACLE["op12_ranked_search"])
    assert ok, why


def test_cases_equal_brute_force(spark):
    docs = [(1, "Red fox, red hen"), (2, "red"), (2, "red"), (None, "red"), (3, None), (4, ""), (5, "... !"),
            (6, "Écoute écoute RED"), (7, "fox " * 5000 + "hen"), (-8, "hen fox"), (9, "x" * 100_000)]
    items = [(1, "Red fox"), (1, "hen hen HEN"), (2, None), (3, "?"), (None, "écoute"), (4, "nothing known"),
             (5, "red red fox"), (5, "red red fox")]
    got = found(ranked_search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k=3))
    assert got == brute(docs, items, k=3)


def test_blocks_of_items_give_the_same(spark):
    docs = [(i, " ".join(f"w{(i * j) % 17}" for j in range(1, 2 + i % 9))) for i in range(300)]
    items = [(i, f"w{i} w{i + 1} w3 z") for i in range(9)]
    d, q = spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS)
    assert found(ranked_search(d, q, block_bytes=20)) == found(ranked_search(d, q)) == brute(docs, items)


def test_empty_tables_and_other_columns(spark):
    d, q = spark.createDataFrame([(1, "a b", 7)], DOCS + ", score int"), spark.createDataFrame([(1, "a", 7)], ITEMS + ", rank int")
    assert ranked_search(d.limit(0), q).collect() == [] and ranked_search(d, q.limit(0)).collect() == []
    out = ranked_search(d, q)
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 1


def test_long_texts_are_counted_in_pieces():
    text = "ab " * 900_000 + "c" * (3 << 20) + " ab"
    assert term_counts(text) == Counter({b"ab": 900_001, b"c" * (3 << 20): 1})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 80), min_size=1, max_size=60), min_size=1, max_size=40), st.integers(1, 70),
       st.integers(1, 7))
def test_masks_find_the_best(docs, width, size):
    """Segments of any size and items of any number of terms find the documents of highest score."""
    import numpy as np

    counts = [dict(Counter(t for t in d if t < 75)) for d in docs]
    item = _Item(np.arange(width), np.arange(1, width + 1) * 3, 5)
    segment = _Segment(size)
    for i, c in enumerate(counts):
        if c:
            segment.add(i, 25 + len(docs[i]), c)
            if segment.full():
                segment.search([item], 80)
                segment = _Segment(size)
    segment.search([item], 80)
    want = sorted(((sum((t + 1) * 3 * ((10 ** 9 * v) // (1000 * v + 8 * (25 + len(docs[i])))) for t, v in c.items() if t < width), -i)
                   for i, c in enumerate(counts)), reverse=True)
    assert sorted(((e[0], e[2]) for e in item.best), reverse=True) == [w for w in want if w[0] > 0][:5]
