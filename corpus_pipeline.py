"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of the table
``documents``; the last returns one row per packed piece. Rows with nulls go through: a null or
letterless text, or one in no language that was learned, ends at the first stage; null ids,
languages and sources do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import decontaminate, exact_dedup, jaccard, langid, packing
from orderflow.llm.common import fresh_path, prepare, table
from orderflow.llm.queries import VOCABULARY


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; null and letterless texts and foreign ones go."""
    prepare(spark)
    return langid.accepted(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepare(spark)
    return exact_dedup.distinct_texts(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words at a similarity of 0.8."""
    prepare(spark)
    return jaccard.one_per_group(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, one row per piece."""
    prepare(spark)
    return packing.pack(docs, VOCABULARY)


STAGES = [("language ID", language_id), ("exact dedup", exact_duplicates),
          ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontamination),
          ("packing", pack)]

#: Prediction by partial matching and byte-pair merging are beyond SQL; tests compare the stages
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = fresh_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
