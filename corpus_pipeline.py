"""The corpus pipeline: from raw documents to the tokens of a deduplicated mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read back as the next stage's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen.llm import bpe, exact_dedup, jaccard_join, language_id, mixing
from almacen.llm.stored import stored


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification, trained on the labelled ones, does not reject."""
    return language_id.accepted(docs, language_id.train(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each different text, that with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id."""
    return jaccard_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and token ids of each row, and the digest of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokenizer = bpe.ByteBpe(spark, path, public_tokenizers.PATTERN)
    found = tokenizer.decode(tokenizer.encode(docs))
    return found.select("doc_id", "n_tokens", "ids", F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", keep_known_languages),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: Language models and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
