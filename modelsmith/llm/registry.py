"""The queries of the thirteen operators and the pipeline, with their DuckDB SQL.

A query applies its operator to the whole table and reduces the result to the
columns that are compared. Where there is no SQL, ``tests/llm`` holds the operator
against brute force or the library it must equal; the learned scores of operator 8
and the posterior of operator 1 by held-out accuracy and by hand-written cases.
"""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelsmith.llm import (
    decontamination, exact_dedup, line_dedup, piece_codec, quality, sharding, simhash, spelling, token_counts, topk_search, toxicity, turn_trie,
    url_filters,
)
from modelsmith.llm.tables import table

#: Where the vocabulary files lie: a folder, or the installed package of public tokenizers.
TOKENIZERS = os.environ.get("MODELSMITH_TOKENIZERS", "")


def tokenizer_path(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    return importlib.import_module("public_tokenizers").path(name)


def op1_url_filters(spark: SparkSession, data_dir: str) -> DataFrame:
    judged = url_filters.judge_urls(table(spark, data_dir, "pages"), table(spark, data_dir, "labels"), suffixes=url_filters.SUFFIXES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_line_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, data_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_deleted", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op3_sentencepiece(spark: SparkSession, data_dir: str) -> DataFrame:
    return piece_codec.codec_digests(table(spark, data_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op4_toxicity(spark: SparkSession, data_dir: str) -> DataFrame:
    return toxicity.judge_toxicity(table(spark, data_dir, "documents"), table(spark, data_dir, "labels"))


def op5_decontamination(spark: SparkSession, data_dir: str) -> DataFrame:
    return decontamination.judge_contamination(decontamination.find_passages(table(spark, data_dir, "documents"), table(spark, data_dir, "benchmark")))


def op6_token_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, data_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_simhash(spark: SparkSession, data_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, data_dir, "documents"))


def op8_quality(spark: SparkSession, data_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, data_dir, "documents"), table(spark, data_dir, "labels"))


def op9_sharding(spark: SparkSession, data_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, data_dir, "documents"))


def op10_topk_search(spark: SparkSession, data_dir: str) -> DataFrame:
    vectors = topk_search.quantise(table(spark, data_dir, "embeddings"))
    return topk_search.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op11_exact_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, data_dir, "documents"))


def op12_turn_trie(spark: SparkSession, data_dir: str) -> DataFrame:
    return turn_trie.turn_trie(table(spark, data_dir, "conversations"))


def op13_spelling(spark: SparkSession, data_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.count_words(table(spark, data_dir, "documents")))


def pipeline(spark: SparkSession, data_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, data_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_url_filters, op2_line_dedup, op3_sentencepiece, op4_toxicity, op5_decontamination, op6_token_counts, op7_simhash, op8_quality,
              op9_sharding, op10_topk_search, op11_exact_dedup, op12_turn_trie, op13_spelling, pipeline)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from modelsmith.llm.oracles import ORACLES

    return dict(ORACLES)
