"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet to the shared scratch folder and
reads it again as the next stage's documents. All but the last keep the columns of documents. A table without rows passes
through all stages; extra columns are kept until the last one, which returns its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from webmart.llm import mixing, pieces, secret_scan, simhash, toxicity
from webmart.llm.common import saved

#: The tokenizer of the last stage.
TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold, by a network trained on the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.learn(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by the kind of secret."""
    return secret_scan.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics reach their target weights."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids with the end id, and the text that the ids decode to."""
    return pieces.encode_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: Trained networks, fingerprints and tokenizers have no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
