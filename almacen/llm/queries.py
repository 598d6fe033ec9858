"""The registered queries of this subpackage, with DuckDB SQL where SQL can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen.llm import (
    bpe,
    chat_format,
    class_lm,
    exact_dedup,
    jaccard_join,
    language_id,
    licenses,
    metric_join,
    mixing,
    ranked_search,
    sharding,
    source_audit,
    sql,
    suffix_dedup,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(of: int):
    """crc32 of the doc_id as text (null: empty), modulo ``of``."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % of


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _remainder(4) == 2
    models = language_id.train(docs.filter(~held_out))
    found = language_id.identify(docs, models)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.render(_table(spark, sf_dir, "conversations"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.metric_components(_table(spark, sf_dir, "embeddings"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens(spark, _table(spark, sf_dir, "documents"))


def tokens(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Digests of the token ids and of the decoded bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokenizer = bpe.ByteBpe(spark, path, public_tokenizers.PATTERN)
    found = tokenizer.decode(tokenizer.encode(docs))
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _remainder(7) == 2
    found = class_lm.score_texts(docs, ~held_out)
    return found.withColumn("held_out", held_out)


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(_table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(_table(spark, sf_dir, "documents"))
    sizes = F.zip_with("until", "from", lambda until, start: until - start)
    none = F.lit(0).cast("long")
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(sizes, none, lambda total, size: total + size).alias("n_removed"),
        F.size("from").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return ranked_search.search(documents, items)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_mixing,
        op3_exact_dedup,
        op4_language_id,
        op5_chat_format,
        op6_jaccard_join,
        op7_embedding_dedup,
        op8_byte_bpe,
        op9_license_scan,
        op10_lm_scoring,
        op11_source_audit,
        op12_suffix_dedup,
        op13_ranked_search,
    )
}

SQL = {
    "op2_mixing": sql.MIXING,
    "op3_exact_dedup": sql.EXACT_DEDUP,
    "op5_chat_format": sql.CHAT_FORMAT,
    "op6_jaccard_join": sql.JACCARD_JOIN,
    "op7_embedding_dedup": sql.EMBEDDING_DEDUP,
    "op9_license_scan": sql.LICENSES,
    "op11_source_audit": sql.SOURCE_AUDIT,
    "op12_suffix_dedup": sql.SUFFIX_DEDUP,
    "op13_ranked_search": sql.RANKED_SEARCH,
}
