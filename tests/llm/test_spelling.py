"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from llm_help import frame

from marketlens.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + 1:] == b[p + 1:] if len(a) == len(b) else a[p:] == b[p + 1:]


def brute_counts(rows):
    out = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def brute(rows):
    n = brute_counts(rows)
    out, form = {}, {}
    for w in n:
        other = [v for v in n if near(w, v)]
        best = min(other, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = (n[w], len(other), n[form[w]] if form[w] else None)
    root = {}
    for w in n:
        r = w
        while form[r]:
            r = form[r]
        root[w] = r
    return {w: (form[w], root[w], *out[w]) for w in n}


def run(spark, rows, **kw):
    got = S.variants(frame(spark, rows), **kw).collect()
    assert len({g.word for g in got}) == len(got)
    return {g.word: tuple(g)[1:] for g in got}


def corpus(seed, n_words, alphabet="abcd", docs=40):
    r = random.Random(seed)
    base = ["".join(r.choices(alphabet, k=r.randrange(4, 9))) for _ in range(n_words)]
    for w in list(base):
        for _ in range(2):
            at, kind = r.randrange(len(w)), r.randrange(3)
            base.append(w[:at] + r.choice(alphabet) * (kind > 0) + w[at + (kind < 2):])
    weights = [r.choice([1, 1, 2, 4, 8, 16]) for _ in base]
    return [(i, " ".join(r.choices(base, weights, k=300))) for i in range(docs)]


@pytest.mark.parametrize("leaf", [1, 3, 20, 100_000])
def test_all_pairs_at_every_cut(spark, leaf):
    rows = corpus(3, 60)
    assert run(spark, rows, leaf=leaf) == brute(rows)


def test_pairs_of_the_composition():
    r = random.Random(1)
    for _ in range(60):
        words = sorted({"".join(r.choices("ab", k=r.randrange(0, 7))) for _ in range(25)})
        got = [tuple(sorted(p)) for p in S.Acceptor(words).pairs()]
        assert len(got) == len(set(got))
        assert set(got) == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_acceptor_is_minimal():
    a = S.Acceptor(sorted({x + y for x in ("a", "b", "c") for y in ("xx", "xy", "z")}))
    assert len(a.edges) == 4                        # start, after a letter, after x, end
    assert len({(f, tuple(e.items())) for f, e in zip(a.final, a.edges)}) == len(a.edges)


def test_letters_case_deletions(spark):
    text = "Ünder ünder UNDER under Under ×÷×÷× naïve naive NAIVE naÏve b1ackbird blackbird O'Brien don't größer groeßer grösser"
    rows = [(i, text) for i in range(120)] + [(None, text)] * 3 + [(5, None), (6, ""), (7, text), (7, text)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert "ackbird" in got and got["ünder"][3] >= 1 and len(got) > 10


def test_chains_of_forms(spark):
    words = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbc"]
    rows = [(10 ** 6, " ".join(w for k, w in enumerate(words) for _ in range(3 * 2 ** k)))]
    got = run(spark, rows, leaf=2)
    assert got == brute(rows)
    assert got["aaaaa"][1] == "bbbbc"


def test_documents(spark, docs01, texts01):
    want = brute_counts(texts01.items())
    got = {r.word: r for r in S.variants(docs01).collect()}
    assert {w: r.n for w, r in got.items()} == want
    # near words by the deletion neighbourhood
    holes = {}
    for w in want:
        for p in range(len(w) + 1):
            holes.setdefault(w[:p] + w[p + 1:] if p < len(w) else w, set()).add(w)
    for w, r in list(got.items()):
        cand = {v for p in range(len(w) + 1) for v in holes.get(w[:p] + w[p + 1:] if p < len(w) else w, ())} | holes.get(w, set())
        other = [v for v in cand if near(w, v)]
        best = min(other, key=lambda v: (-want[v], v), default=None)
        form = best if best is not None and want[best] >= 2 * want[w] else None
        assert (r.n_near, r.form, r.form_n) == (len(other), form, want.get(form))
        assert r.root == (got[form].root if form else w)


def test_very_long_runs(spark):
    a = "ab" * 20000
    rows = [(i, f"{a}c {a}d {a}cc x{a} short") for i in range(4)]
    got, want = run(spark, rows), brute_counts(rows)
    assert set(got) == set(want)
    assert got[a + "c"][3] >= 2


def test_empty_and_clashing_columns(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, None), (2, "a b c")]) == {}
    df = spark.createDataFrame([(i, "colour color colour", "x", 1, 2) for i in range(5)], "doc_id long, text string, word string, n long, depth int")
    got = {r.word: r.n for r in S.variants(df).collect()}
    assert got == brute_counts([(i, "colour color colour") for i in range(5)])
