import random
import re

from llm_help import frame

from marketlens.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, win string"


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return WORD.findall(low)


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1) if w else []:
            wins.setdefault(tuple(w[k:k + n]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w = words(t)
        hit, ids = set(), set()
        for n in {len(k) for k in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit |= set(range(k, k + n))
                    ids |= wins[tuple(w[k:k + n])]
        out.append((d, len(w), len(hit), sorted(ids, key=str.encode), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def data():
    r = random.Random(6)
    vocab = [f"w{i}" for i in range(400)] + ["the"] * 300 + ["Été", "straße", "x9"]
    text = lambda n: " ".join(r.choices(vocab, k=n))
    items = [(i, text(r.randrange(13, 40))) for i in range(30)] + [(100, "unseen w1"), (101, ""), (102, None), (103, "Solo"), (9, text(14)),
                                                                   (9, text(14)), (None, "the The w1"), (104, "ÉTÉ été")]
    docs = []
    for i in range(200):
        t = text(r.choice([0, 5, 60, 300]))
        if i % 3 == 0:
            it = r.choice(items)[1] or ""
            parts = it.split()
            if i % 2 and len(parts) > 15:
                parts = parts[1:15]
            if i % 9 == 0 and parts:
                parts[len(parts) // 2] = "broken"
            t = t + "... " + ", ".join(parts).upper().replace("É", "É") + "! " + text(4)
        docs.append((i, t))
    docs += [(7, docs[7][1]), (None, docs[3][1]), (300, None), (301, "!!! ..."), (302, "solo, SOLO and Solo"), (303, "the the the w1 the the w1")]
    return docs, items


def test_against_brute_force(spark):
    docs, items = data()
    got = D.contamination(frame(spark, docs, "doc_id long, text string, term string, pos long"), frame(spark, items, ITEMS)).collect()
    assert sorted(((g.doc_id, g.n_words, g.n_hit, g.items, g.contaminated) for g in got), key=str) == brute(docs, items)


def test_blocks_and_shuffled_joins_give_the_same(spark, monkeypatch):
    docs, items = data()
    for name in ("TERMS_BROADCAST", "WINDOWS_BROADCAST", "KEYS_BROADCAST"):
        monkeypatch.setattr(D, name, 60)
    got = D.contamination(frame(spark, docs), frame(spark, items, ITEMS)).collect()
    assert sorted(((g.doc_id, g.n_words, g.n_hit, g.items, g.contaminated) for g in got), key=str) == brute(docs, items)


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    near = item.replace("zeta", "zeta really")
    filler = " ".join(f"f{i}" for i in range(60))
    docs = [(1, f"{filler} {item} {filler}"), (2, f"{filler} {near} {filler}"), (3, f"alpha {filler} beta {filler} gamma mu {filler} nu delta epsilon zeta eta theta iota kappa lambda")]
    got = {g.doc_id: g for g in D.contamination(frame(spark, docs), frame(spark, [(5, item)], ITEMS)).collect()}
    assert got[1].items == ["5"] and got[1].n_hit == 13 and got[1].near_items == []
    assert got[2].items == [] and got[2].n_hit == 0
    assert got[3].items == [] and got[3].near_items == []
    # one word more in the middle: no exact phrase, but all terms stand close to their places
    assert got[2].near_items == ["5"]


def test_clean_documents(spark):
    docs, items = data()
    frame_ = frame(spark, docs, "doc_id long, text string, bad_id long, BAD_HASH string")
    bad = {(d, n) for d, n, _, _, c in brute(docs, items) if c}
    kept = D.clean_documents(frame_, frame(spark, items, ITEMS))
    assert kept.columns == frame_.columns
    want = sorted(str((d, t)) for d, t in docs if (d, len(words(t))) not in bad)
    assert sorted(str((k.doc_id, k.text)) for k in kept.collect()) == want


def test_empty(spark):
    docs, items = data()
    assert D.contamination(frame(spark, []), frame(spark, items, ITEMS)).count() == 0
    got = D.contamination(frame(spark, docs[:3]), frame(spark, [], ITEMS)).collect()
    assert [(g.n_hit, g.contaminated) for g in got] == [(0, False)] * 3
