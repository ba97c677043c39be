"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokenisation.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. ``run`` applies them to the documents table of a
folder; each stage's rows are written as Parquet under the shared folder and
reread as the next one's input. All stages but the last return the columns of
documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchboard.llm import decontaminate, line_dedup, near_dup, quality, sentencepiece_bpe
from switchboard.llm.common import settle, ship_package
from switchboard.session import apply_defaults
from switchboard.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest keep."""
    _ready(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines found in three or more of them; a document whose every line goes stays with an empty text."""
    _ready(spark)
    prefix = "_line"
    while any(c.lower().startswith(prefix.lower()) for c in docs.columns):
        prefix = "_" + prefix
    found, dropped = line_dedup.dedup_lines(docs, prefix=prefix), F.col(f"{prefix}_dropped")
    text = F.when(dropped > 0, F.col(f"{prefix}_text")).otherwise(F.col("text"))
    return found.select(*(
        text.alias("text") if c == "text"
        else F.when(dropped > 0, F.char_length(f"{prefix}_text").cast(docs.schema["n_chars"].dataType))
        .otherwise(F.col("n_chars")).alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more)."""
    _ready(spark)
    return near_dup.keep_one(docs, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    _ready(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of ids, the ids, and digests of ids and decoded text."""
    _ready(spark)
    return sentencepiece_bpe.encode_documents(
        docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"), ids=True).select(
        "doc_id", F.col("_sp_n").alias("n_tokens"), F.col("_sp_ids").alias("ids"),
        F.col("_sp_ids_sha256").alias("ids_sha256"), F.col("_sp_text_sha256").alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_deduplication),
    ("decontamination", benchmark_decontamination),
    ("sentencepiece", tokenize),
]

# The forest's verdict and the token ids have no SQL form; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def _ready(spark: SparkSession) -> None:
    apply_defaults(spark)
    ship_package(spark)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    _ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
