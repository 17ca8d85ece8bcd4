"""Very long texts, repeated rows and clashing columns of the operators that do not test them elsewhere."""

import random
import zlib

import numpy as np
import public_tokenizers as P
from llm_help import frame

from marketlens.llm import decontam, lm, mixing, simhash, token_counts, token_files

R = random.Random(3)
LONG = " ".join("w%d" % R.randrange(5000) for _ in range(200_000))


def test_decontamination(spark):
    item = " ".join("w%d" % R.randrange(5000) for _ in range(20))
    text = LONG + " " + item + " " + LONG[:1000]
    got = decontam.contamination(frame(spark, [(1, text), (2, item), (3, "word " * 300_000)]),
                                 spark.createDataFrame([("a", item), ("b", "word " * 13)], "item_id string, text string")).collect()
    by = {g.doc_id: g for g in got}
    assert by[1].n_hit == 20 and by[1].items == ["a"] and not by[1].contaminated
    assert by[2].contaminated and by[3].n_hit == by[3].n_words == 300_000 and by[3].items == ["b"]


def test_mixing(spark):
    rows = [(1, LONG, None, "a"), (2, "short text", None, "a"), (3, "x " * 10, None, "b")]
    got = {r.doc_id: r for r in mixing.taken_words(frame(spark, rows)).collect()}
    assert got[1].size == 200_000 and all(r.taken <= 2 * r.size for r in got.values())


def test_lm(spark):
    train, held = (next(d for d in range(99) if (zlib.crc32(str(d).encode()) % 5 == 1) == h) for h in (False, True))
    rows = [(train, LONG), (held, LONG[: len(LONG) // 2]), (held, "short")]
    got = lm.score(frame(spark, rows), P.path("piece_bpe_32k.model"), rounds=1).collect()
    assert sorted(g.n_tokens for g in got) == [2, len(rows[1][1].split()) + 1, 200_001] and all(np.isfinite(g.score) for g in got)


def test_simhash(spark):
    rows = [(4, LONG), (2, LONG.upper()), (3, "y" * 1_000_000)]
    got = {r.doc_id: r.component_id for r in simhash.near_groups(frame(spark, rows)).collect()}
    assert got == {4: 2, 2: 2, 3: 3}


def test_token_counts(spark):
    rows = [(1, LONG), (2, "z" * 100_000), (1, LONG)]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n_bytes long, n_tokens string")
    got = token_counts.with_token_counts(docs.select("doc_id", "text"), P.path("piece_bpe_32k.model")).collect()
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    assert sorted((g.doc_id, g.n_bytes, g.n_tokens) for g in got) == sorted((d, len(t.encode()), len(sp.encode(t))) for d, t in rows)


def test_token_files(spark, tmp_path):
    rows = [(1, LONG, 5, "a", 1), (1, LONG, 6, "b", 2), (0, None, 7, "c", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, tie string, tokens long")
    got = sorted(map(tuple, token_files.token_file_digest(docs, P.path("byte_bpe_50k.json"), folder=str(tmp_path / "files")).collect()))
    from tokenizers import Tokenizer
    n = len(Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode(LONG, add_special_tokens=False).ids) + 1
    assert [g[:3] for g in got] == [(0, 0, 1), (1, 1, n), (1, 1 + n, n)] and got[1][3] == got[2][3]
