"""A training corpus from raw documents: five operators in turn.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All but the last return the
columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm import bpe, langid, minhash, mixture, secrets
from gridtally.llm.groups import keep_rows
from gridtally.llm.queries import BYTE_BPE, tokenizer_path
from gridtally.llm.tables import fold, table
from gridtally.session import drop_path, work_path, work_scope
from gridtally.sinks.staging import stage

#: Texts whose language is less sure than this are rejected.
SURE = 0.5


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus teaches; others, and those without a letter, go."""
    model = langid.learn(docs, fold("doc_id", 4) != 2)
    return langid.keep(docs, model, SURE)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    found = minhash.near_duplicates(docs)
    return keep_rows(docs, found.filter("kept"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    return secrets.redacted_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the target mix of sources takes them."""
    return mixture.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with their number."""
    coded = bpe.encode(docs, tokenizer_path(BYTE_BPE))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify),
    ("near_duplicates", deduplicate),
    ("secrets", redact),
    ("mixture", mix),
    ("bpe", encode),
]

#: Language models and BPE are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. What a stage leaves behind is deleted once the next one's is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, function in STAGES[:-1]:
        path = work_path(spark, f"pipeline-{name}")
        with work_scope(spark):
            docs = stage(function(spark, docs, sf_dir), path)
        if before is not None:
            drop_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
