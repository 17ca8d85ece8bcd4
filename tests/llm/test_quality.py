import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_help import frame

from marketlens.llm import quality as Q


def brute_base(t):
    t = t or ""
    words = [w for w in "".join(c if c not in " \t\n\r\x0b\x0c" else " " for c in t).split(" ") if w]
    tri = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if tri[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), failed


ODD = [None, "", " \n\t", "a", "x\x85y z\xa0w", "a b c a b c", "q\nq\n q\nq", "### $5 & <b>", "w " * 80, "é🙂 " * 60,
       "a b c d a b c e " * 30, " ".join(f"u{i}" for i in range(50)), " ".join(f"u{i}" for i in range(49))]


def test_base_counts(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3])]
    got = Q.judged(frame(spark, rows, "doc_id long, text string, lang string, KEPT string, whole_text string"), keep_columns=["doc_id"]).collect()
    assert len(got) == len(rows)
    for g in got:
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == brute_base(ODD[g.doc_id])
        assert not (g.kept and g.base_failed)


def test_js_distance():
    p, q = np.array([1.0, 1, 0]), np.array([0.0, 0, 5])
    assert Q.js_distance(p, q) == pytest.approx(1) and Q.js_distance(p, 7 * p) == 0
    a, b = np.array([0.2, 0.8]), np.array([0.5, 0.5])
    m = (a + b) / 2
    want = math.sqrt(sum(0.5 * x * math.log2(x / y) for d in (a, b) for x, y in zip(d, m)))
    assert Q.js_distance(a, b) == pytest.approx(want)
    assert Q.js_distance(np.zeros(2), a) == 0


def test_references_are_counts_of_all_documents(spark, docs01):
    refs = Q.references(docs01)
    rows = docs01.select("text", "lang").collect()
    for lang in {r.lang for r in rows} | {...}:
        count, classes = Counter(), np.zeros(len(Q.CLASSES))
        for r in rows:
            w = r.text.encode().lower().split()
            if (lang is ... or r.lang == lang) and len(w) >= Q.MIN_WORDS:
                count.update(w)
                classes += Q.class_counts(r.text.encode())
        got_classes, cells, common = refs[lang]
        top = sorted(count, key=lambda w: (-count[w], w))[:Q.COMMON_WORDS]
        assert list(cells) == top and common[:-1].tolist() == [count[w] for w in top]
        assert common.sum() == sum(count.values()) and got_classes.tolist() == classes.tolist()


def test_labelled_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    got = Q.judged(d, keep_columns=["doc_id"]).join(labels, "doc_id").where("NOT base_failed").collect()
    good, bad = [g for g in got if g.quality == 1], [g for g in got if g.quality == 0]
    assert sum(g.kept for g in good) >= 0.995 * len(good)
    assert sum(not g.kept for g in bad) >= 0.9 * len(bad)


def test_unknown_languages_use_the_pool(spark):
    r = random.Random(1)
    text = lambda: " ".join(r.choice(["the", "of", "and", "house", "tree"]) for _ in range(90))
    rows = [(i, text(), "en") for i in range(20)] + [(100, "short", "xx"), (101, " ".join(f"the{i} of" for i in range(60)), "zz"), (102, text(), None)]
    refs = Q.references(frame(spark, rows), languages=2)
    assert len(refs) == 3 and ... in refs and "en" in refs
    assert {g.doc_id for g in Q.judged(frame(spark, rows)).collect()} == {x[0] for x in rows}


def test_every_language_has_its_own_reference(spark):
    """More languages than are broadcast: the smallest are judged by their own words, not by the pool."""
    r = random.Random(2)
    rows = []
    for k in range(300):
        words = [f"w{k}x{j}" for j in range(30)]
        rows += [(10 * k + i, " ".join(r.choice(words) for _ in range(300 - k // 2)), f"l{k}" if k != 299 else None) for i in range(3)]
    rows += [(5000 + i, "only short texts", "short") for i in range(3)]
    got = {g.doc_id: g for g in Q.judged(frame(spark, rows), keep_columns=["doc_id", "lang"]).collect()}
    assert len(got) == len(rows) and all(got[d].kept == (lang != "short") for d, _, lang, *_ in rows)
    for k in (0, 200, 270, 298, 299):
        mine = [(d, t.encode().split()) for d, t, lang in rows if lang == (f"l{k}" if k != 299 else None)]
        count = Counter(w for _, ws in mine for w in ws)
        for d, ws in mine:
            p = np.array([ws.count(w) for w in count], dtype=float)
            assert got[d].common_distance == pytest.approx(Q.js_distance(p, np.array(list(count.values()), dtype=float)))
    assert {g.doc_id for g in Q.keep_good(frame(spark, rows)).collect()} == {d for d, _, lang, *_ in rows if lang != "short"}


def test_keep_good_keeps_columns(spark, docs01):
    docs = docs01.withColumnRenamed("n_chars", "N_words").withColumnRenamed("source", "quality_kept")
    kept = Q.keep_good(docs)
    assert kept.dtypes == docs.dtypes
    want = {g.doc_id for g in Q.judged(docs01, keep_columns=["doc_id"]).collect() if g.kept}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == want
    assert {r.doc_id: (r.text, r.N_words) for r in rows}.items() <= {r.doc_id: (r.text, r.N_words) for r in docs.collect()}.items()


def test_empty(spark):
    assert Q.judged(frame(spark, [])).count() == 0 and Q.keep_good(frame(spark, [])).count() == 0


def test_long_texts_count_the_same(monkeypatch):
    import random
    r = random.Random(6)
    for vocabulary in (2, 30, 100000):
        words = [b"w%d" % r.randrange(vocabulary) for _ in range(9000)]
        monkeypatch.setattr(Q, "LONG_TEXT", 10 ** 9)
        want = Q.repeated_words(words)
        monkeypatch.undo()
        assert Q._repeated_in_long(words) == Q.repeated_words(words) == want


def test_very_long_text_and_clashing_columns(spark):
    rows = [(i, "the cat sat on a mat by the door " * 30, "en", True, 1.0) for i in range(5)] + [(9, "word " * 400000, "en", False, 2.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept boolean, class_distance double")
    got = {r.doc_id: r for r in Q.judged(df, keep_columns=["doc_id"]).collect()}
    assert got[9].n_words == 400000 and got[9].n_repeat_words == 400000 and got[9].base_failed
    assert Q.keep_good(df).columns == df.columns
