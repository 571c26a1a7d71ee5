"""Families that do not link, clashing names, repeated labels, and the pipeline stage by stage."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from linewise.llm import fair_mix, jaccard_join, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)


def _components(rows):
    """doc_id -> smallest doc_id of its component, by comparing all pairs."""
    sets = {}
    for i, text, _ in rows:
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                high, low = sorted((find(a), find(b)), reverse=True)
                root[high] = low
    return {i: find(i) for i in ids}


def _family(rng, base, size, edits):
    """Copies of ``base`` with so many words changed, each differently."""
    for _ in range(size):
        copy = list(base)
        for at in rng.sample(range(len(copy)), edits):
            copy[at] = f"w{rng.randrange(10_000)}"
        yield " ".join(copy)


def test_families_near_the_threshold(spark):
    """Sets that share most tokens: some link, most do not; families of over one block of comparisons."""
    rng = random.Random(11)
    base = [f"b{k}" for k in range(150)]
    texts = list(_family(rng, base, 330, 4)) + list(_family(rng, base, 40, 2)) + [" ".join(base)]
    texts += list(_family(rng, [f"c{k}" for k in range(60)], 30, 2))
    rng.shuffle(texts)
    rows = [(k * 3, t, "s") for k, t in enumerate(texts)]
    got = jaccard_join.jaccard_components(_docs(spark, rows)).select("doc_id", "component_id").collect()
    expected = _components(rows)
    assert 40 < len(set(expected.values())) < len(rows)
    assert {r.doc_id: r.component_id for r in got} == expected


def test_mix_keeps_columns_of_the_same_names(spark):
    rows = [(k, f"word {k} " * (1 + k % 4), f"s{k % 3}") for k in range(60)]
    plain = _docs(spark, rows)
    named = plain.selectExpr("*", "'mine' AS size", "doc_id + 1 AS KEY", "0 AS taken", "1 AS mix_taken")
    out = fair_mix.mixed_documents(named)
    assert out.columns == named.columns + ["mix_size", "source_size", "target", "mix_mix_taken", "copies"]
    kept = {r.doc_id: r for r in out.collect()}
    wanted = {r.doc_id: r for r in fair_mix.mix_sources(plain).collect() if r.taken}
    assert set(kept) == set(wanted) and kept
    for i, r in kept.items():
        assert (r["size"], r["KEY"], r["taken"], r["mix_taken"]) == ("mine", i + 1, 0, 1)
        assert (r["mix_size"], r["mix_mix_taken"]) == (wanted[i]["size"], wanted[i].taken)


def test_toxicity_with_repeated_ids_and_labels(spark):
    bad, good = "you stupid vermin shut up", "the river runs along the old mill"
    rows = [(k, f"{bad if k % 3 == 0 else good} {k}", "s") for k in range(120)]
    labels = [(k, int(k % 3 == 0)) for k in range(120)]
    labels += labels[:10] + [(5, 1), (6, 0)]  # repeated; two ids whose labels disagree
    docs = _docs(spark, rows + [(7, "another text of the same id", "s")] * 3 + [(8, None, "s"), (None, bad, "s")])
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    first, again = (sorted(map(tuple, toxicity.score_toxicity(d, t).collect()), key=repr)
                    for d, t in ((docs, table), (docs.repartition(5), table.repartition(3))))
    assert first == again and len(first) == 125
    held = [r for r in first if r[1]]
    assert held and all(r[3] == int(r[0] % 3 == 0) for r in held)


def test_pipeline_stage_by_stage(spark, tmp_path):
    rng = random.Random(5)
    words = ("the river of old mill town was and in to people water house road morning work year from with market field "
             "small child winter story letter night light garden stone hand voice window summer village street").split()

    def prose(n):
        sentences = []
        while n > 0:
            k = min(n, rng.randrange(8, 15))
            sentences.append(" ".join(rng.choice(words) for _ in range(k)).capitalize() + ".")
            n -= k
        return " ".join(sentences)
    texts = [prose(rng.randrange(60, 140)) for _ in range(40)]
    item = " ".join(f"question{k} asks" for k in range(30))
    shared = prose(60)
    rows = [(k, t, f"s{k % 3}") for k, t in enumerate(texts)]
    rows += [(100 + k, texts[3], "hot") for k in range(30)]  # a hot group of copies
    rows += [(200, texts[4].replace("river", "stream", 1), "s1"), (201, f"{texts[5]} {item} {prose(20)}", "s2")]
    rows += [(210 + k, f"{prose(70)} {shared} {prose(70)}", "s0") for k in range(3)]
    rows += [(300, None, "s1"), (301, "", None), (None, prose(80), None), (302, "#### $$$$ 1234 " * 30, "s1")]
    _docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    docs, before = spark.read.parquet(f"{tmp_path}/documents.parquet"), None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/out{k}")
        out = spark.read.parquet(f"{tmp_path}/out{k}")
        got = [(r.doc_id, r.text, r.source) for r in out.collect()]
        if k < 4:
            assert out.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
        if name.startswith("quality"):
            ids = {i for i, _, _ in got}
            assert len([i for i in range(40) if i in ids]) >= 38 and 302 not in ids
        elif name.startswith("n-gram"):
            of = _components([r for r in before if r[0] is not None])
            wordless = [r[0] for r in before if r[0] is not None and not (r[1] or "").split()]
            assert Counter(i for i, _, _ in got if i is not None) == Counter({*of.values(), *wordless})
        elif name.startswith("substring"):
            assert len(got) == len(before)
            held = [t for i, t, _ in got if i in (210, 211, 212)]
            assert sum(shared in (t or "") for t in held) <= 1
        elif name.startswith("benchmark"):
            ids = {i for i, _, _ in got}
            assert 201 not in ids and {r[0] for r in before} - ids <= {201}
        else:
            assert {i for i, _, _ in got} <= {r[0] for r in before} and got
        docs, before = out, got
    empty = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
