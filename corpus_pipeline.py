"""Corpus pipeline: the stages that turn ``documents`` into token files.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir) and
returns a DataFrame.  ``run`` writes each stage's result as Parquet in the shared
folder and reads it back as the next stage's ``docs``, so a lost executor costs
at most one stage's tasks.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import decontam, mixing, quality, simhash, token_files
from marketlens.llm.common import read_table, written
from marketlens.llm.queries import BYTE_BPE, END_ID, prepare, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    prepare(spark)
    return quality.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    prepare(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    prepare(spark)
    return decontam.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back."""
    prepare(spark)
    return token_files.token_file_digest(docs, tokenizer_path(BYTE_BPE), end_id=END_ID)


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", simhash_dedup),
          ("benchmark decontamination", decontamination), ("mixing sources", source_mix),
          ("token-ID output", token_output)]

# Fingerprints, divergences and tokenizer ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table documents."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
