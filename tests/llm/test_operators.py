"""Each operator against a brute-force version, an exact round trip or held-out accuracy, with edge rows."""

import base64
import hashlib
import random
import re
import textwrap
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from linewise.llm import (decontaminate, fair_mix, jaccard_join, licences, recompression, rp_forest, suffix_repeats,
                          toxicity, warc_bundles, weak_quality)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tag int, node string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _docs(spark, rows):
    """Rows of (doc_id, text, source); the table has extra columns with names that operators use."""
    full = [(i, t, "en", s, None if t is None else len(t), 1, "x") for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8))) for _ in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(90)]
    rows = []
    for k in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 200))]
        if k % 4 == 0:
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage
        rows.append((k * 2, " ".join(words), f"s{k % 4 if k % 3 else 0}"))
    base = [w for w in rows[5][1].split()]
    for k in range(12):  # near copies of one text, each with a word changed
        copy = list(base)
        copy[rng.randrange(len(copy))] = "changed"
        rows.append((1000 + k, "\n".join(copy).upper() if k % 5 == 0 else " ".join(copy), "s1"))
    rows += [(2000, rows[7][1], None), (2001, rows[7][1], None), (2001, rows[7][1], None)]  # copies and a repeated row
    rows += [(3000, None, "s1"), (3001, "", "s2"), (3002, "one two", None), (3003, "one  two\t", "s3"), (None, "a null id " * 20, "s1"),
             (3004, "same " * 300, "s2"), (3005, "same " * 400, "s2"), (3006, "x" * 5000, "s3"), (3007, "y" + "x" * 4000, "s3")]
    rows.append((4000, " ".join(rng.choice(vocabulary) for _ in range(120_000)), "s0"))  # very long
    return rows


def test_jaccard_components(spark, corpus):
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard_join.jaccard_components(_docs(spark, corpus)).collect()}
    sets = []
    for i, text, _ in corpus:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        s = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        sets.append((i, s))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, s) in enumerate(sets):
        if s and i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    assert got == {(i, len(s)): least.get(find(k)) if s else i for k, (i, s) in enumerate(sets)}


def test_one_of_each_component_stays(spark, corpus):
    docs = _docs(spark, corpus)
    kept = jaccard_join.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[14] == 1 and not ids[2000] and not ids[2001]  # copies of row 7 (id 14)
    assert ids[3000] == ids[3001] == ids[3002] == 1 and not ids[3003] and ids[None] == 1
    found = jaccard_join.jaccard_components(docs).where("set_key is not null and component_id is not null").collect()
    assert {i for i in ids if i is not None} == {r.component_id for r in found} | {3000, 3001}
    assert sum(ids.values()) == len(ids)


def test_removed_words(spark, corpus):
    rows = [(i, WORD.findall(t or "")) for i, t, _ in corpus]
    first = {}
    for i, w in rows:
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            first[key] = min(first.get(key, 1 << 63), 1 << 63 if i is None else i)
    expected = Counter()
    for i, w in rows:
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < (1 << 63 if i is None else i):
                gone[k:k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        expected[i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = recompression.dedup_words(_docs(spark, corpus)).drop("kept_text").collect()
    assert Counter(tuple(r) for r in got) == expected
    out = recompression.without_repeats(_docs(spark, corpus))
    assert out.columns == _docs(spark, corpus).columns and out.count() == len(corpus)


def test_removed_bytes(spark, corpus):
    rows = [(i, (t or "").encode()) for i, t, _ in corpus]
    seen = Counter(t[k:k + 400] for _, t in rows for k in range(len(t) - 399))
    expected = Counter()
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 399):
            if seen[t[k:k + 400]] > 1:
                gone[k:k + 400] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        expected[i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")] += 1
    assert Counter(tuple(r) for r in suffix_repeats.dedup_bytes(_docs(spark, corpus)).collect()) == expected


def test_many_repeated_rows(spark):
    """Spans of equal rows are listed once, so thousands of equal rows cost what they hold."""
    text = " ".join(f"w{k * k % 997}x{k}" for k in range(200))
    rows = [(1, text, "a")] + [(5, text, "a")] * 2000 + [(None, text, "b")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    words = {(r.doc_id, r.n_removed): r["count"] for r in recompression.dedup_words(df).groupBy("doc_id", "n_removed").count().collect()}
    assert words == {(1, 0): 1, (5, 200): 2000, (None, 200): 50}
    size = len(text.encode())
    gone = {(r.doc_id, r.n_removed): r["count"] for r in suffix_repeats.dedup_bytes(df).groupBy("doc_id", "n_removed").count().collect()}
    assert gone == {(1, size): 1, (5, size): 2000, (None, size): 50}
    left = {(r.doc_id, r.text): r["count"] for r in recompression.without_repeats(df).groupBy("doc_id", "text").count().collect()}
    assert left == {(1, text): 1, (5, ""): 2000, (None, ""): 50}


def test_texts_that_share_an_id_stay_apart(spark):
    """2,000 different texts under the null id and as many under one id, against brute force."""
    rng = random.Random(16)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(2000)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passages = [text(80) for _ in range(4)]
    docs = [(1, " ".join(passages), "s")]
    for k in range(4000):
        parts = [text(rng.randrange(1, 60)), text(rng.randrange(1, 60))]
        if k % 2 == 0:
            parts.insert(1, passages[k // 2 % 4])
        docs.append((None if k < 2000 else 7, " ".join(parts), "s"))
    least, windows = {}, Counter()
    for i, t, _ in docs:
        w, raw = t.split(), t.encode()
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            least[key] = min(least.get(key, 1 << 63), 1 << 63 if i is None else i)
        windows.update(raw[k:k + 400] for k in range(len(raw) - 399))
    by_words, by_bytes = Counter(), Counter()
    for i, t, _ in docs:
        w, raw = t.split(), t.encode()
        gone, lost = np.zeros(len(w), bool), np.zeros(len(raw), bool)
        for k in range(len(w) - 12):
            if least[tuple(w[k:k + 13])] < (1 << 63 if i is None else i):
                gone[k:k + 13] = True
        for k in range(len(raw) - 399):
            if windows[raw[k:k + 400]] > 1:
                lost[k:k + 400] = True
        by_words[i, " ".join(x for x, g in zip(w, gone) if not g)] += 1
        by_bytes[i, len(raw), int(lost.sum()), hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~lost])).hexdigest()] += 1
    df = _docs(spark, docs)
    assert Counter((r.doc_id, r.kept_text) for r in recompression.dedup_words(df).collect()) == by_words
    assert Counter((r.doc_id, " ".join(r.text.split())) for r in recompression.without_repeats(df).collect()) == by_words
    got = suffix_repeats.dedup_bytes(df).select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()
    assert Counter(tuple(r) for r in got) == by_bytes


def test_mix_reaches_targets(spark, corpus):
    rows = fair_mix.mix_sources(_docs(spark, corpus)).collect()
    assert len(rows) == len(corpus)
    size = {}
    for (i, t, s), n in ((x, len(WORD.findall(x[1] or ""))) for x in corpus):
        size.setdefault(s, []).append(n)
    total = sum(map(sum, size.values()))
    # Weights 5, 2, 1 by code point, null last; full sources give the rest away by weight.
    names = sorted((s for s in size if s is not None)) + [None]
    weight = dict(zip(names, [5, 2, 1, 5, 2, 1]))
    target, open_names, left = {}, list(names), 1.5 * total
    while True:
        level = left / sum(weight[s] for s in open_names)
        full = [s for s in open_names if 2 * sum(size[s]) < level * weight[s]]
        if not full:
            break
        for s in full:
            target[s] = 2 * sum(size[s])
            left -= target[s]
            open_names.remove(s)
    target |= {s: level * weight[s] for s in open_names}
    assert sorted({round(r.target, 6) for r in rows}) == sorted({round(t, 6) for t in target.values()})
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows) and sum(r.taken for r in rows) <= 1.5 * total
    again = fair_mix.mix_sources(_docs(spark, corpus).repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_licences(spark):
    rows = [(1, licences.KNOWN[10][1], None), (2, "COPYRIGHT (c) 2020 Someone\n" + licences.KNOWN[10][1].upper().replace(",", " ;"), None),
            (3, "Some text.\nReleased under the M.I.T.\nreleased  under the mit LICENCE", None), (4, None, None), (5, "", None),
            (5, "", None), (None, "Released under the MIT License.", None)]
    got = [(r.doc_id, r.licence_id, r.line_licences) for r in licences.licence_scan(_docs(spark, rows)).collect()]
    assert Counter(got) == Counter([(1, "MIT", ""), (2, "MIT", ""), (3, None, "MIT"), (4, None, ""), (5, None, ""), (5, None, ""),
                                    (None, "MIT", "MIT")])


def test_whole_licences_and_wrapped_notices(spark):
    texts = {"MIT": licences.KNOWN[10][1]}
    for path in sorted((Path(licences.__file__).parent / "licence_texts").glob("*.txt")):
        texts[path.stem] = path.read_text()
    wrap = lambda text, n: "\n\n".join(textwrap.fill(p, n) for p in licences.unwrapped(text).split("\n\n"))
    rows, expected = [], {}
    for name, text in texts.items():
        forms = [text, licences.unwrapped(text), "Copyright (c) 2021, Someone\nAll rights reserved.\n\n" + text, text.upper()]
        if name != "GPL-3.0":  # its head has a copyright line that goes on as text
            forms += [wrap(text, 50), "\n".join("# " + line for line in wrap(text, 71).split("\n"))]
        for form in forms:
            expected[len(rows)] = name.removesuffix("-Regents")
            rows.append((len(rows), form, None))
    got = {r.doc_id: r.licence_id for r in licences.licence_scan(_docs(spark, rows)).collect()}
    assert got == expected
    notices = [(1, "Some text.\nLicensed under the Apache License, Version\n2.0.\nMore text.", None),
               (2, "First.\n\nThis work is licensed\nunder the GNU General\nPublic License, version 3.\n\nLast.", None),
               (3, "Released under\nno licence", None)]
    found = {r.doc_id: (r.licence_id, r.line_licences) for r in licences.licence_scan(_docs(spark, notices)).collect()}
    assert found == {1: (None, "Apache-2.0"), 2: (None, "GPL-3.0"), 3: (None, "")}


def _distance(p: str, t: str) -> int:
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        last, row = row, [i]
        for j, d in enumerate(t, 1):
            row.append(min(last[j - 1] + (c != d), last[j] + 1, row[-1] + 1))
    return min(row)


def test_decontamination_matches_alignment(spark):
    rng = random.Random(8)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(n))
    items = [(k, text(20)[:100]) for k in range(6)] + [(6, "short"), (7, None)]
    docs = []
    for k in range(40):
        leak = list(items[k % 6][1])
        for _ in range(k // 4):
            leak[rng.randrange(1, len(leak) - 1)] = rng.choice(["", "z", "zz"])
        docs.append((k, text(60) + " " + "".join(leak).upper() + "! " + text(30), None))
    docs += [(100, None, None), (101, "", None), (102, text(200), None), (None, items[0][1], None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated_documents(_docs(spark, docs), bench).collect()}
    expected = set()
    for i, t, _ in docs:
        for item, p in items[:6]:
            p = decontaminate.normal(p).tobytes().decode().strip()
            if t and _distance(p, decontaminate.normal(t).tobytes().decode()) <= int(len(p) * 0.06):
                expected.add((i, item))
    assert got == expected
    left = decontaminate.without_contaminated(_docs(spark, docs), bench)
    assert {r.doc_id for r in left.collect()} == {i for i, _, _ in docs} - {i for i, _ in expected}


def test_decontamination_finds_passages_cut_anywhere(spark):
    rng = random.Random(21)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(n))
    items = [(k, text(60)) for k in range(8)] + [(20, text(19)[:90].strip()), (30, "zebra quiz at noon"), (31, "zulu")]
    docs, expected = [], set()

    def plant(item, passage):
        docs.append((len(docs), text(40) + " " + passage + " " + text(25), None))
        expected.add((len(docs) - 1, item))
    for n in (50, 51, 56, 57, 64, 80, 99, 100, 120, 149, 200):
        for k in range(8):
            at = rng.randrange(len(items[k][1]) - n + 1)
            plant(k, items[k][1][at:at + n].upper() if k % 2 else items[k][1][at:at + n])
    for k in range(40):  # 57 bytes or more with up to 3 edits, far apart and not at the ends
        n = rng.randrange(57, 130)
        at = rng.randrange(len(items[k % 8][1]) - n + 1)
        leak = list(items[k % 8][1][at:at + n])
        for place in rng.sample(range(2, n - 2), k % 4):
            leak[place] = rng.choice(["", "z", leak[place] + "z"])
        plant(k % 8, "".join(leak))
    plant(20, items[8][1])
    plant(30, "Zebra, quiz at noon!")
    docs += [(1000, "Zulu.", None), (1001, text(9) + " zulu", None), (1002, "xzebra quiz at noon", None), (1003, text(400), None)]
    docs += [(1004 + k, text(30) + " " + items[k][1][5:35] + " " + text(30), None) for k in range(8)]  # 30 bytes are too few
    expected.add((1000, 31))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated_documents(_docs(spark, docs), bench)
    assert Counter((r.doc_id, r.item_id) for r in found.collect()) == Counter(expected)
    left = {r.doc_id for r in decontaminate.without_contaminated(_docs(spark, docs), bench).collect()}
    assert left == {i for i, _, _ in docs} - {i for i, _ in expected}


def test_quality_keeps_prose_and_rejects_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = weak_quality.score_quality(docs).join(labels, "doc_id").select("quality", "kept").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1
    edge = _docs(spark, [(1, None, None), (2, "", None), (None, "!!! ### $$$ " * 30, None)])
    assert [r.kept for r in weak_quality.score_quality(edge.unionByName(edge)).orderBy("doc_id").collect()][2:] == [False] * 4


def test_warc_round_trip(spark, tmp_path):
    pages = [(5, "http://a b", "<p>é</p>"), (3, "u", "<p>é</p>"), (9, None, "<p>é</p>"), (1, "u", None), (2, "u", ""), (4, "u", "x" * 300_000),
             (None, "u", "null id"), (7, "line\r\nbreak", "\r\n\r\nWARC/1.1\r\n\r\n")]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, digest string")
    index = warc_bundles.write_bundles(df, str(tmp_path / "warc"), frame_bytes=200, bundle_bytes=2000)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc_bundles.read_bundles(index).collect()}
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    for i, _, h in pages:
        payload = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = i is not None and first[h or ""] != i
        assert got[i] == (len(payload), digest, "revisit" if revisit else "response", first[h or ""] if revisit else None)
    entry = index.where("page_id = 4").first()
    head, body = warc_bundles.read_record(entry.bundle, entry.frame, entry.offset, entry.length)
    assert head["x-page-id"] == "4" and body.endswith(b"x" * 300_000)
    assert warc_bundles.warc_round_trip(df.where("false")).count() == 0


def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors, label = [], []
    for c in range(30):
        center = rng.standard_normal(16)
        for _ in range(20):
            vectors.append((center + 0.25 * rng.standard_normal(16)).tolist())
            label.append(c % 2)
    vectors += [vectors[0]] * 3 + [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, vectors[0], []]
    label += [0, 0, 1, 0, 0, 0, 0, None, 0]
    rows = [(k, v, x, "extra") for k, (v, x) in enumerate(zip(vectors, label))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node string")
    got = {r.vec_id: r for r in rp_forest.near_duplicates(df, leaf=64, block=32).collect()}
    ok = [k for k, (v, x) in enumerate(zip(vectors, label)) if x is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    unit = {k: np.array(vectors[k], np.float32).astype(float) for k in ok}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    links = {k: {j for j in ok if j != k and label[j] == label[k] and unit[j] @ unit[k] >= 0.93} for k in ok}
    found = sum(got[k].n_links for k in got)
    assert all(got[k].n_links <= len(links.get(k, ())) for k in got)
    assert found >= 0.9 * sum(map(len, links.values())) > 0
    assert all(got[k].n_links == 0 and got[k].component_id == k for k in got if k not in links)
    assert all(got[k].kept == (got[k].component_id == k) for k in got)


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score_toxicity(docs, labels).cache()
    assert scored.count() == docs.count() and scored.where("score < 0 or score > 1 or score is null").count() == 0
    got = scored.join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    right = np.mean([r.toxic == r.predicted for r in got])
    caught = np.mean([r.predicted for r in got if r.toxic])
    assert right > 0.97 and caught > 0.8


def test_empty_tables(spark):
    docs = _docs(spark, [(1, "x", None)]).where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert jaccard_join.jaccard_components(docs).count() == 0
    assert licences.licence_scan(docs).count() == 0
    assert decontaminate.contaminated_documents(docs, bench).count() == 0
    assert weak_quality.score_quality(docs).count() == 0
    assert suffix_repeats.dedup_bytes(docs).count() == 0
    assert toxicity.score_toxicity(docs, labels).count() == 0
    assert recompression.dedup_words(docs).count() == 0
    assert fair_mix.mix_sources(docs).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert rp_forest.near_duplicates(vectors).count() == 0
