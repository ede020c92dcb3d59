"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, decontamination, encoding.

Each stage calls one operator of ``modelsmith.llm`` on all that the stage before
kept (decisions are taken on the judged row itself, never by id); :func:`run` writes each stage's result as Parquet to the cluster's shared
folder and reads it back. Every stage but the last returns the columns of the
table ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelsmith.llm import decontamination, line_dedup, piece_codec, simhash, toxicity
from modelsmith.llm.registry import tokenizer_path
from modelsmith.llm.scratch import stage
from modelsmith.llm.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go. Null and empty texts and repeated rows are judged each; an empty table stays empty."""
    judged = toxicity.judge_toxicity(docs, table(spark, sf_dir, "labels"), carry=COLUMNS)
    return judged.where("predicted = 0").select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted from the texts; n_chars follows. A text may become empty."""
    kept = line_dedup.dedup_lines(docs)
    return kept.select("doc_id", "text", "lang", "source", F.when(F.col("n_deleted") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: that of the smallest id (null last), of these the smallest by its content's hash."""
    rows = docs.withColumn("row", F.sha2(F.to_json(F.struct(*COLUMNS)), 256))
    printed = stage(simhash.fingerprints(rows, carry=["row"]), "prints")
    # Rows that are equal in all columns share the hash; one of them stays.
    return rows.join(simhash.first_rows(printed, "row"), "row", "left_semi").dropDuplicates(["row"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Null and empty texts hold none and stay, repeated rows are judged each."""
    found = decontamination.find_passages(docs, table(spark, sf_dir, "benchmark"), carry=COLUMNS)
    return found.where(F.size("word_spans") == 0).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text, for every row; a null text counts as empty."""
    return piece_codec.codec_digests(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: Learned scores, hashes by XXH64 and the tokenizer have no SQL; tests/llm holds the operators of the stages against
#: brute force and libraries, and the stages against hand-written results.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
