"""From raw documents to packed training sequences, one operator after the other.

Every stage is a function of (spark, docs, sf_dir); what it returns is written as Parquet and
reread as the docs of the next one. Stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell.llm.common import fold, stored
from sparkwell.llm.exact_dedup import exact_copies_removed
from sparkwell.llm.jaccard_join import nearest_removed
from sparkwell.llm.language_id import learn, without_language_removed
from sparkwell.llm.packing import pack
from sparkwell.llm.secret_scan import redact
from sparkwell.llm.tokens import tokenizer_path

#: Chunks of text whose ids a worker keeps: it also holds what the stages before have left there, so fewer than in a query of its own.
CACHED_CHUNKS = 1 << 16


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found go."""
    return without_language_removed(docs, learn(docs, fold("doc_id", 4) != 2))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact_copies_removed(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return nearest_removed(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays. A source owns its documents."""
    return redact(docs, F.concat_ws("/", "source", "lang"), F.col("source"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048, sources mixed as they stand in the input."""
    return pack(docs, tokenizer_path("byte_bpe_50k.json"), cached=CACHED_CHUNKS)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("secret_scan", secrets),
    ("packing", packing),
]

#: Language models, links through chains of documents and token ids are beyond SQL; the tests compare
#: each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
