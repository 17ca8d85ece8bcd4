import random

import pytest
from llm_help import frame

from marketlens.llm import mixing as M


def brute_targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5):
    """Reshare the excess over twice the size until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, free, target = share * sum(sizes.values()), set(order), {}
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total > 2 * sizes[s]}
        if not over:
            target |= {s: left * w[s] / total for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    return target


def rows():
    r = random.Random(1)
    out = []
    for i in range(600):
        src = r.choice(["a", "b", "Z", "é", None, "big", "big", "big"])
        out.append((i, " ".join(["w"] * r.choice([0, 1, 5, 40, 200])), "en", src))
    return out + [(None, "no id", "en", "a"), (3, None, "en", "a"), (3, "", "en", "empty"), (9, "same row", "en", "a"), (9, "same row", "en", "a")]


def test_targets_and_budgets(spark):
    data = rows()
    got = M.taken_words(frame(spark, data)).collect()
    assert len(got) == len(data)
    sizes = {}
    for _, t, _, s in data:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    taken = {}
    for g in got:
        assert g.source_size == sizes[g.source]
        assert g.target == pytest.approx(want[g.source])
        assert 0 <= g.taken <= 2 * g.size and (g.size == 0 or g.taken % g.size == 0)
        taken[g.source] = taken.get(g.source, 0) + g.taken
    for s in sizes:      # a prefix of the hash order: at most half of one document off
        assert abs(taken[s] - want[s]) <= 101, s


def test_reruns_and_partitioning_agree(spark):
    data = rows()
    one = sorted(map(str, M.taken_words(frame(spark, data)).collect()))
    random.Random(5).shuffle(data)
    assert sorted(map(str, M.taken_words(frame(spark, data).repartition(7)).collect())) == one


def test_documents_repeat_as_often_as_taken(spark):
    data = rows()
    docs = frame(spark, data, "doc_id long, text string, lang string, source string, cut_base string, size long")
    taken = {}
    for g in M.taken_words(docs).collect():
        if g.size:
            taken[g.doc_id] = taken.get(g.doc_id, 0) + g.taken // g.size
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    seen = {}
    for r in out.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: v for k, v in taken.items() if v}


def test_empty_and_wordless(spark):
    assert M.taken_words(frame(spark, [])).count() == 0
    got = M.taken_words(frame(spark, [(1, "", "en", "a"), (2, None, "en", None)])).collect()
    assert [(g.size, g.target, g.taken) for g in got] == [(0, 0.0, 0)] * 2
