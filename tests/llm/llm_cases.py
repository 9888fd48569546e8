"""Rows and fixtures that the tests of the training-data operators share."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for path in (ROOT, os.path.join(ROOT, "tests")):
    if path not in sys.path:
        sys.path.append(path)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF001 = "/root/testdata/sf0.001"
DOC_DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"

PROSE = ("the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions of amber jade "
         "and onyx near the old stone bridge at dawn before any traveller wakes to see them work in silence ")

#: Nulls, empty and blank texts, ties, repeated rows, non-ASCII, long runs of one character.
EDGE = [
    (1, None, None, None, None), (2, "", "en", "", 0), (3, " \n\t ", "en", "a", 4), (None, "no id here", "en", "a", 10),
    (None, "no id here", "en", "a", 10), (4, "a" * 700, "en", "a", 700), (5, "añb " * 300, "es", "a", 1200),
    (6, PROSE * 2, "en", "a", 0), (6, PROSE * 2, "en", "a", 0), (7, "x " + PROSE * 2, "en", "b", 0),
    (8, "Ünder the MIT License.\nSPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\n", "de", None, 1),
    (9, "12 34 56", None, "b", 8), (10, "日本語テキスト" * 60, "ja", "b", 420), (-11, "one", "en", "b", 3),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Edge rows, with extra columns whose names clash with computed ones."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(EDGE, DOC_DDL)
    return df.withColumns({c: F.lit("clash") for c in (
        "kept", "n_words", "fp", "uid", "row", "id", "start", "spans", "h", "shard", "tokens", "weight", "score",
        "key", "root", "body", "fence", "__text")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_DDL)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="session")
def plain(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
