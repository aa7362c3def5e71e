"""The corpus pipeline: each stage's table is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import decontaminate, piece_codec, secret_scan, simhash, toxicity
from quayside.llm.queries import tokenizer
from quayside.llm.store import prepare, written


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold. An id without a label teaches nothing."""
    return toxicity.drop_toxic(docs, _read(spark, sf_dir, "labels"))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs)


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, _read(spark, sf_dir, "benchmark"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each found secret replaced by a mask; ``n_chars`` follows the text."""
    masked = secret_scan.mask_secrets(docs)
    return masked.selectExpr(
        *[
            "if(text is null, n_chars, cast(length(text) as bigint)) as n_chars" if c == "n_chars" else f"`{c}`"
            for c in masked.columns
        ]
    )


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their piece ids."""
    prepare(spark)
    return piece_codec.encode(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxic_out),
    ("simhash near-dedup", near_duplicates_out),
    ("benchmark decontamination", leaks_out),
    ("secret scans", secrets_masked),
    ("sentencepiece encoding", encoded),
]

# Learned weights, SimHash components and a Viterbi search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
