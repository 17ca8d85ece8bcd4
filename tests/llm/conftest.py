import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools"), os.path.join(ROOT, "tests", "llm")]

from llm_help import SF01  # noqa: E402


@pytest.fixture(scope="module")
def docs01(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet")


@pytest.fixture(scope="module")
def texts01(docs01):
    return {r.doc_id: r.text for r in docs01.select("doc_id", "text").collect()}

