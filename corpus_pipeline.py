"""A training corpus from `documents`: toxic documents out, one of each group of near copies, personal data redacted,
sources mixed to their target weights, texts encoded.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from allelix.llm import bpe, mixing, pii, simhash, toxicity
from allelix.llm.common import shared_folder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier does not reject."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near copies (five words, similarity of 0.8 or more)."""
    return simhash.one_of_each(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target draws it."""
    return mixing.mix(docs).drop("mix_shard", "mix_order")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and token ids of each document of the mix."""
    return bpe.encode_documents(docs, VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]
#: SQL has no compression distance, SimHash or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written to the shared checkpoint folder and read again."""
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            at = f"{folder}/pipeline-{uuid.uuid4()}/{name}"
            docs.write.parquet(at)
            docs = spark.read.parquet(at)
    return docs
