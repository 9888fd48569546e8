"""The corpus pipeline: five stages from ``documents`` to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's rows as Parquet in the shared folder and rereads them for the next. All but
the last return the columns of ``documents``. A stage's result is stored before the next
stage is called on the same folder, which then removes the scratch tables of the stage before
it, and no others: frames that a caller holds from the operators themselves stay readable.

Defined cases: null and empty texts fail the quality rules; of repeated rows one stays, as of
any group of copies; ties go to the smaller id; very long texts are read whole by every stage;
null ids, languages and sources are values of their own; an empty table gives no rows; further
columns are not carried.
"""

from __future__ import annotations

from functools import wraps
from threading import get_ident

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardstream.llm import mixing, packing, quality_rules, simhash, suffix_dedup
from cardstream.llm.common import remove, scratch_scope, table, written
from cardstream.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


# Scratch tables of the last stage, per thread and folder.
_MADE: dict[tuple[int, str], list[str]] = {}


def stage(work):
    """A stage: drops the scratch tables of the stage before it and keeps its own for the next."""
    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, _MADE.pop((get_ident(), sf_dir), []))
        with scratch_scope() as made:
            out = work(spark, docs, sf_dir)
        _MADE[get_ident(), sf_dir] = made
        return out
    return run


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality_rules.quality_filter(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.near_duplicates_removed(docs)


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat; ``n_chars`` follows the text."""
    out = suffix_dedup.repeats_removed(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint"))


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the tempered source, language and topic weights."""
    return mixing.mixed(docs)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of up to 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path(), remember=200_000)      # workers serve all stages


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing", mix),
    ("packing", pack),
]

#: Fingerprints, suffix order and token ids are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, work in STAGES[:-1]:
        docs = written(work(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
