"""A corpus from raw documents to packed training sequences: toxicity, exact copies, near copies, private data, packing.

Each stage takes the documents its predecessor kept and returns documents with the same columns, the last one the pieces
of the sequences. Between stages the documents are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import exact_copies, near_copies, packing, private_data, toxicity
from meterline.llm.queries import WORD_TOKENIZER, tokenizer_file
from meterline.llm.storage import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels of the documents at hand."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal without white space."""
    return exact_copies.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths or more of its five-word shingles."""
    return near_copies.drop_near_copies(docs, width=5, percent=80)


def redact_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose personal data is replaced by its kind; ``n_chars`` follows the text."""
    redact = private_data.redactor(private_data.train(docs))
    return docs.withColumn("text", redact(F.col("text"))).withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 4096 tokens."""
    return packing.pack(packing.token_pieces(docs, tokenizer_file(WORD_TOKENIZER)))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii", redact_private_data),
    ("best_fit_packing", pack_sequences),
]

# Trained models and tokenizers are beyond SQL; the tests hold the run against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
