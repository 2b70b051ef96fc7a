"""Cleans and packs a corpus: toxicity, near copies, repeated passages, benchmark leaks, packing.

A stage takes rows with null ids or texts, repeated rows, further columns of any name, and none at all, as its operator's docstring says: rows
without an id are told apart by their texts; of rows that repeat an id one stays in the near-copy stage; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import decontaminate, packing, repeats, simhash, toxicity
from gristmill.llm.common import shared_folder, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by fingerprints of three-word shingles within two bits the one with the smallest id stays."""
    return simhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of more than 50 words, or of 400 bytes or more, that start more than once are cut out of the texts; every document stays."""
    return repeats.remove_passages(docs, words=repeats.WORDS)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token sequences and their places."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic), ("simhash_near_duplicates", without_near_copies), ("suffix_dedup", without_repeats),
    ("decontamination", without_leaks), ("packing", packed),
]
# Language models, fingerprints and tokenizers are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
