"""The corpus pipeline: five stages from ``documents`` to packed sequences.

Each stage is one operator of ``orderflow.llm``; its result is written as
Parquet in the shared folder and read again as the next stage's ``docs``. All
but the last return the columns of ``documents``.

Defined results: null texts count as empty; an empty table goes through all
stages and gives no piece; extra columns of ``docs`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import mixing, near_dedup, packing, personal, quality
from orderflow.llm.common import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier accepts (operator 1), learned from ``labels``."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 7)."""
    return near_dedup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by its kind (operator 8)."""
    return personal.masked(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: documents dropped, cut or repeated (operator 5)."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of fixed-length sequences (operator 9)."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", minhash_near_dedup),
    ("PII", personal_data),
    ("mixing sources to target weights", source_mixing),
    ("packing", packing_stage),
]

#: The stages learn models and tokenize, which SQL cannot express; tests hold the
#: stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` at ``sf_dir``; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k + 1}")
    return docs
