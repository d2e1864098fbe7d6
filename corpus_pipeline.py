"""The corpus pipeline: stages over the documents table, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, line_dedup, pieces, simhash, toxicity
from tickloom.llm.batches import short_batches
from tickloom.llm.queries import table, tokenizer
from tickloom.llm.shipping import ship
from tickloom.session import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    ship(spark)
    short_batches(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines the first stays; ``n_chars`` follows the text. A document that loses all its lines
    goes, as they all stand elsewhere; blank documents stay."""
    ship(spark)
    kept = line_dedup.dedup_lines(docs).filter((F.col("n_dropped") < F.col("n_lines")) | (F.col("n_lines") == 0))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship(spark)
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with end id and the text decoded from them."""
    ship(spark)
    short_batches(spark)
    return pieces.encoded_and_decoded(docs, tokenizer("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", encoding_stage),
]

#: Learning, signatures, fingerprints and encoding are beyond SQL; tests/llm holds the brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
