import zlib

import numpy as np
import pytest
import public_tokenizers as P
from llm_help import frame

from marketlens.llm import token_counts as C, token_files as T
from marketlens.llm.common import Memo, grouped

ODD = ["", None, " ", "  ", "\n", " \n ", "a  b", "a\nb ", "▁", "a▁▁b", "I'm 12 o'clock  \n\n x's", "a\x1cb \x1d c", "x<|endoftext|> y",
       "　 a​b\xa0 c", "  a\r\n\tb", "🙂  é ² Ⅷ1 नमस्ते", "a" * 5000, " " * 100, "a\n" + " " * 40 + "b", "Привет, мир!", "É'S don't", "</s> <s>"]


@pytest.fixture(scope="module")
def piece():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def bpe():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_counts_equal_the_library(piece, texts01):
    texts = ODD + list(texts01.values())
    want = [len(x) for x in piece.encode([t or "" for t in texts])]
    assert C.Counter(P.path("piece_bpe_32k.model")).count(texts) == want


def test_small_memo_changes_nothing(piece, texts01, monkeypatch):
    monkeypatch.setattr(C, "KEEP", 50)
    texts = list(texts01.values())[:60]
    assert C.Counter(P.path("piece_bpe_32k.model")).count(texts) == [len(x) for x in piece.encode(texts)]


def test_proof_rejects_a_crossing_vocabulary(piece):
    class Crossing:
        def __getattr__(self, name):
            return getattr(piece, name)

        def id_to_piece(self, i):
            return "a▁b" if i == 500 else piece.id_to_piece(i)

    with pytest.raises(ValueError):
        C.prove(Crossing())


def test_count_columns(spark, piece):
    docs = frame(spark, [(i, t) for i, t in enumerate(ODD)], "doc_id long, text string, N_BYTES long, whole_text string")
    out = C.with_token_counts(docs, P.path("piece_bpe_32k.model"))
    assert out.columns == ["doc_id", "whole_text", "n_bytes", "n_tokens"]
    for r in out.collect():
        t = ODD[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(piece.encode(t)))
    assert C.with_token_counts(frame(spark, []), P.path("piece_bpe_32k.model")).count() == 0


def test_encoder_equals_the_library(bpe, texts01):
    texts = ODD + list(texts01.values())
    enc = T.Encoder(P.path("byte_bpe_50k.json"))
    want = [np.asarray(e.ids, dtype="<u2").tobytes() for e in bpe.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert list(enc.encode_all(texts)) == want


def test_files_round_trip(spark, bpe, tmp_path):
    rows = [(50 - i if i % 7 else None, t) for i, t in enumerate(ODD)] + [(9, "twice"), (9, "twice"), (9, "once")]
    folder = str(tmp_path / "files")
    manifest = T.write_shards(frame(spark, rows), P.path("byte_bpe_50k.json"), folder, shards=5)
    got = T.read_documents(manifest, folder, P.path("byte_bpe_50k.json")).collect()
    got.sort(key=lambda r: r.start)
    assert len(got) == len(rows)
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    ids = sorted(([*bpe.encode(t or "", add_special_tokens=False).ids, 0] for _, t in rows), key=str)
    want = sorted((len(i), zlib.crc32(np.asarray(i, dtype="<u4").tobytes())) for i in ids)
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    # the flat files themselves, one after the other, hold all ids
    total = sum(r["tokens"] for r in manifest.collect())
    assert total == at == sum(len(T.open_array(folder, f"shard-{r['shard']:06d}.bin", "<u2")) for r in manifest.collect())


def test_empty_table(spark, tmp_path):
    manifest = T.write_shards(frame(spark, []), P.path("byte_bpe_50k.json"), str(tmp_path / "none"))
    assert manifest.count() == 0
    assert T.read_documents(manifest, str(tmp_path / "none"), P.path("byte_bpe_50k.json")).count() == 0


def test_memo_and_groups():
    m = Memo(3, 2)
    calls = []

    def make(keys):
        calls.append(sorted(keys))
        return [k.upper() for k in keys]

    assert m.get(["a", "b", "a", "long"], make) == ["A", "B", "A", "LONG"]
    assert m.get(["a", "long"], make) == ["A", "LONG"] and calls[-1] == ["long"]
    m.get(["c", "d"], make)
    assert m.get(["a", "e"], make) == ["A", "E"] and calls[-1] == ["e"]
    assert list(grouped([3, 3, 3, 1], 5)) == [(0, 2), (2, 4)] and list(grouped([], 5)) == []


def test_equal_rows_are_dealt_to_several_shards(spark, tmp_path):
    docs = spark.range(6000).selectExpr("CAST(7 AS BIGINT) AS doc_id", "'the same text' AS text").repartition(4)
    manifest = T.write_shards(docs, P.path("byte_bpe_50k.json"), str(tmp_path / "same"), shards=6)
    sizes = [r.docs for r in manifest.collect()]
    assert sum(sizes) == 6000 and max(sizes) < 3000
    got = sorted(r.start for r in T.read_documents(manifest, str(tmp_path / "same"), P.path("byte_bpe_50k.json")).collect())
    step = got[1] - got[0]
    assert got == list(range(0, 6000 * step, step))
