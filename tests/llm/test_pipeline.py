"""The pipeline's stages against brute force, the registered queries against SQL."""

import random

import __spark_entry__ as E
import corpus_pipeline as CP
import pytest
from llm_help import SF001, SF01, union_find
from oracle_check import compare, duck
from test_decontam import brute as brute_decontam
from test_simhash import brute_fp

from marketlens.llm import mixing, quality, queries
from marketlens.llm.common import read_table


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF01, con, verbose=True)
    assert r["cols_ok"] and r["types_ok"] and r["match"], r


def test_every_operator_is_registered():
    names = [k.split("_")[0] for k in queries.queries() if k != "decontamination_proximity"]
    assert sorted(names) == sorted(f"op{i}" for i in range(1, 14)) and E.queries()["pipeline"] is CP.run
    assert [n for n, _ in CP.STAGES] and len(CP.STAGES) == 5


@pytest.fixture(scope="module")
def stages(spark):
    """The documents after each stage but the last."""
    docs = read_table(spark, SF01, "documents")
    out = [docs]
    for _, stage in CP.STAGES[:-1]:
        out.append(stage(spark, out[-1], SF01).cache())
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay(stages):
    assert all(s.dtypes == stages[0].dtypes for s in stages)


def test_quality_stage(stages):
    want = [g.doc_id for g in quality.judged(stages[0], keep_columns=["doc_id"]).collect() if g.kept]
    assert ids(stages[1]) == sorted(want)


def test_simhash_stage(stages):
    rows = [(r.doc_id, brute_fp(r.text)) for r in stages[1].collect()]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (rows[i][1] ^ rows[j][1]).bit_count() <= 2]
    root = union_find(range(len(rows)), links)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root[i]] = min(low.get(root[i], d), d)
    assert ids(stages[2]) == sorted(low.values())


def test_decontamination_stage(spark, stages):
    items = [(r.item_id, r.text) for r in read_table(spark, SF01, "benchmark").collect()]
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert ids(stages[3]) == sorted(d for d, _, _, _, bad in brute_decontam(rows, items) if not bad)


def test_mixing_stage(stages):
    taken = {r.doc_id: r.taken // r.size for r in mixing.taken_words(stages[3]).collect() if r.size}
    assert ids(stages[4]) == sorted(d for d, n in taken.items() for _ in range(n))


def test_last_stage_and_run(spark, stages):
    out = CP.STAGES[-1][1](spark, stages[4], SF01).orderBy("start").collect()
    assert [r.doc_id for r in out] == ids(stages[4])
    at = 0
    for r in out:
        assert r.start == at
        at += r.n_tokens
    assert sorted(map(tuple, CP.run(spark, SF01).collect())) == sorted(map(tuple, out))


def test_empty_table(spark, tmp_path):
    for name in ("documents", "benchmark"):
        read_table(spark, SF001, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert CP.run(spark, str(tmp_path)).count() == 0


def test_null_columns_and_clashing_names(spark, tmp_path):
    r = random.Random(1)
    rows = [(i if i % 5 else None, " ".join(r.choices(["the", "of", "tree", "house", "and"], k=90)) if i % 7 else None, None, None, None, i)
            for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, HASH int")
    read_table(spark, SF001, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in CP.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "HASH"]
    assert CP.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
