"""Vector codes against a plain product quantiser."""

import hashlib
import math
import random

import numpy as np
import pytest
from llm_help import SF001

from marketlens.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows]
    rows.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    if not rows:
        return [], ""
    dims = len(rows[0][1])
    rows = [r for r in rows if len(r[1]) == dims]
    cut = [(dims * i // parts, dims * (i + 1) // parts) for i in range(parts)]
    books = [[r[1][lo:hi] for r in rows[:entries]] for lo, hi in cut]

    def near(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = {}
        for _, v, _ in rows:
            for p, (lo, hi) in enumerate(cut):
                groups.setdefault((p, near(p, v[lo:hi])[1]), []).append(v[lo:hi])
        for (p, e), members in groups.items():
            books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    out, by_label = [], {}
    for i, v, lab in rows:
        found = [near(p, v[lo:hi]) for p, (lo, hi) in enumerate(cut)]
        err = sum(d for d, _ in found)
        by_label[lab] = by_label.get(lab, 0) + err
        out.append((i, "".join(f"{e:02x}" for _, e in found), err, lab))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, min(err, V.LONG_MAX), min(by_label[lab], V.LONG_MAX), digest) for i, c, err, lab in out), key=repr), digest


def run(spark, rows, schema=SCHEMA):
    return sorted((tuple(r) for r in V.codes(spark.createDataFrame(rows, schema)).collect()), key=repr)


def vectors(n, dims, seed, scale=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(0, scale) for _ in range(dims)], r.choice([None, 0, 1, 2])) for i in range(n)]


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert run(spark, rows) == brute(rows)[0]


@pytest.mark.parametrize("n,dims,scale", [(5, 8, 1.0), (200, 16, 0.001), (60, 13, 3.0), (40, 3, 1.0), (90, 8, 1e6), (40, 8, 1e12)])
def test_brute_force(spark, n, dims, scale):
    rows = vectors(n, dims, n, scale)
    assert run(spark, rows) == brute(rows)[0]


def test_dropped_repeated_and_odd_rows(spark):
    rows = vectors(50, 16, 1)
    rows += [(100, None, 1), (101, rows[0][1][:-1] + [None], 1), (102, rows[0][1][:-1] + [float("nan")], 1),
             (103, rows[0][1][:-1] + [float("inf")], None), (104, [0.5] * 8, 2), (105, [], 2), (None, rows[3][1], None)]
    rows += [rows[7]] * 40 + [(7, rows[8][1], 0)]
    got = run(spark, rows)
    assert got == brute(rows)[0]
    assert len(got) == 50 + 1 + 41


def test_ties_and_hot_copies(spark):
    rows = [(i, [0.0] * 8, 0) for i in range(30)] + [(i, [float(i % 3)] * 8, 0) for i in range(30, 300)]
    assert run(spark, rows) == brute(rows)[0]


def test_empty_vectors_and_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1)]) == []
    got = run(spark, [(1, [], 1), (2, [], None)])
    assert [(g[0], g[1], g[2]) for g in got] == [(1, "00" * 8, 0), (2, "00" * 8, 0)]


def test_clashing_columns(spark):
    rows = [(i, v, lab, 1.0, "x", 5, 2) for i, v, lab in vectors(40, 8, 2)]
    got = run(spark, rows, SCHEMA + ", v float, code string, error long, of_label int")
    assert got == brute([r[:3] for r in rows])[0]


def test_walk_carries_its_stack():
    r = np.random.default_rng(0)
    rows = r.integers(-3, 4, (4000, 5))
    entries = r.integers(-3, 4, (16, 5))
    want = ((rows[:, None, :] - entries[None]) ** 2).sum(axis=2)
    for block in (1, 7, 64, 5000):
        entry, dist = V.nearest(rows, entries, block)
        assert (entry == want.argmin(axis=1)).all() and (dist == want.min(axis=1)).all()


def test_walk_keeps_the_shared_prefix():
    rows = np.array([[1, 2, 3, x] for x in range(100)])
    walk = V.TrieWalk(np.zeros((2, 4), dtype=np.int64))
    walk.block(rows[:50])
    before = [s.copy() for s in walk.stack]
    walk.block(rows[50:])
    assert [s.tolist() for s in walk.stack[:3]] == [s.tolist() for s in before[:3]]
    assert walk.stack[3].tolist() == [14 + 99 * 99] * 2
