"""Corpus pipeline: quality rules, line deduplication, near-duplicate removal,
source mixing, packing.

Each stage takes what the one before kept, written as Parquet and read again, and
all but the last return the columns of ``documents``.  Packing has no SQL form, so
``ORACLE_SQL`` is None and the tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.llm import linededup, mixing, packing, rules, simhash
from beforeafter.llm.common import free_name, stage
from beforeafter.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the strict policy."""
    return rules.apply_policy(docs, rules.STRICT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated long lines; n_chars follows the text."""
    counts = (free_name(docs, "_before"), free_name(docs, "_dropped"))
    found = linededup.dedup_lines(docs, min_chars=40, min_docs=5, counts=counts)
    kind = docs.schema["n_chars"].dataType
    return found.withColumn("n_chars", F.char_length("text").cast(kind)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group within 4 bits of SimHash."""
    return simhash.keep_first(docs, shingle=4, seed=42, max_bits=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture draws them, shard after shard, each
    locally shuffled."""
    return mixing.mix(docs).shuffled().select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents placed into sequences of 2048 tokens; the copies
    of a document that is drawn more than once are packed one by one."""
    return packing.pack_documents(docs, tokenizer_path(), capacity=2048, end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("pack", pack),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
