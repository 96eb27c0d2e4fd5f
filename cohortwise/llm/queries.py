"""The registered queries of the training-data operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, merkle, mixing, neardup, packing, quality, records, secret_scan, sharding, simhash, substrings, topk, trie
from .common import read
from .oracles import ORACLES as ORACLES


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), width=4)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), with_ids=False)


def op6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digests(read(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.integer_vectors(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(rows, F.col("id") % 100 == 0)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.learn(docs.where(~held_out).select("lang", "text"))
    return langid.predict(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out})


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_nodes(read(spark, sf_dir, "conversations"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(read(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix, op2_secrets, op3_sharding, op4_near_duplicates, op5_packing,
        op6_records, op7_substrings, op8_top_k, op9_quality, op10_language,
        op11_prefix_trie, op12_manifest, op13_simhash,
    )
}
