import random

import numpy as np
import xxhash
from llm_help import frame, union_find

from marketlens.llm import simhash as S
from marketlens.llm.components import connected_components


def brute_fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows):
    """rows: (doc_id, fp) -> component_id per row, by comparing all pairs."""
    links = [(i, j) for i in range(len(rows)) for j in range(i) if bin(rows[i][1] ^ rows[j][1]).count("1") <= 2]
    root = union_find(range(len(rows)), links)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root[i]] = min(low.get(root[i], d), d)
    return [low.get(root[i]) for i in range(len(rows))]


def near_rows(spark, n=400):
    r = random.Random(4)
    words = ["w%d" % i for i in range(300)]
    rows = []
    for i in range(n):
        if i % 4 == 0 or not rows:
            t = " ".join(r.choices(words, k=r.choice([0, 1, 2, 3, 30, 200])))
        else:
            w = r.choice(rows)[1].split()
            if w and i % 3:
                w[r.randrange(len(w))] = "changed%d" % r.randrange(5)
            t = " ".join(w)
        rows.append((i, t))
    return rows + [(None, rows[3][1]), (None, "only nulls have this text here"), (7, rows[7][1]), (5000, None), (5001, "   ")]


def test_fingerprint_matches_definition():
    for t in ["", None, "a", "A b", "a b c", "x y z x y z x", "é É ß", "w " * 70000]:
        assert S.fingerprint((t or "").encode().lower().split()) == brute_fp(t)


def test_groups_match_all_pairs(spark):
    rows = near_rows(spark)
    for leaf in (1024, 4):      # a tiny leaf makes Spark walk deep pairs
        got = S.near_groups(frame(spark, rows), leaf=leaf).collect()
        fps = [(d, brute_fp(t)) for d, t in rows]
        want = sorted(zip([str(d) for d, _ in fps], [f for _, f in fps], map(str, brute_groups(fps))))
        assert sorted((str(g.doc_id), g.fp % (1 << 64), str(g.component_id)) for g in got) == want


def test_close_pairs_and_forest():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    x = np.unique(np.concatenate([base, base ^ (np.uint64(1) << r.integers(0, 64, 40).astype(np.uint64)),
                                  base ^ np.uint64(3), base ^ np.uint64(7)]))
    i, j = S.close_pairs(x, x, 0, 0, True)
    want = {(a, b) for a in range(len(x)) for b in range(a + 1, len(x)) if bin(int(x[a] ^ x[b])).count("1") <= 2}
    assert set(zip(i.tolist(), j.tolist())) == want
    low = S.forest(i, j, len(x))
    root = union_find(range(len(x)), want)
    assert [root[int(v)] for v in low] == [root[v] for v in range(len(x))]


def test_one_of_each_keeps_smallest(spark):
    rows = near_rows(spark)
    docs = frame(spark, rows, "doc_id long, text string, HEAD_ID string, fp long")
    kept = S.one_of_each(docs).collect()
    fps = [(d, brute_fp(t)) for d, t in rows]
    comps = brute_groups(fps)
    heads = {c for c in comps if c is not None}
    assert sorted(k.doc_id for k in kept if k.doc_id is not None) == sorted(heads)
    assert [k.text for k in kept if k.doc_id is None] == ["only nulls have this text here"]
    assert kept[0].__fields__ == ["doc_id", "text", "HEAD_ID", "fp"]


def test_empty(spark):
    assert S.near_groups(frame(spark, [])).count() == 0
    assert S.one_of_each(frame(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1060)] + [(5, 5), (None, 3), (2000, 2001), (2001, 2000)]
    r.shuffle(links)
    got = {x.vertex: x.component for x in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1060)} | {2000: 2000, 2001: 2000}
    assert got == want
