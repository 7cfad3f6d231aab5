"""From raw documents to packed sequences: five stages, each over all that the one before it kept.

Each stage takes (spark, docs, sf_dir); all but the last return documents with the same columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm import decontamination, jaccard, packing, quality, secrets
from gustline.llm.queries import CAPACITY, table
from gustline.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a base rule nor the likelihood ratio rejects."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_one(docs)


def free_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.free_of(docs, table(spark, sf_dir, "benchmark"))


def free_of_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with secrets replaced by a mark."""
    clean = secrets.redact(docs, owner=F.col("source"), repo=F.concat_ws("/", "source", "lang"))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of fixed capacity."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, tokenizer=path, end_id=0, capacity=CAPACITY)


STAGES = [
    ("quality rules", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", free_of_benchmark),
    ("secret scans", free_of_secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"stage-{number}")
    return docs


#: Tokens and hashed scores have no SQL form; the pipeline is tested against plain Python.
ORACLE_SQL = None
