"""The operators as queries over the given tables, each with production parameters and over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import (
    collocations, exact_copies, main_text, near_copies, packing, periodic_runs, pieces, private_data, quality_rules, secret_scan,
    sharding, toxicity, warc,
)

# Names of the installed public tokenizer files.
PIECE_MODEL = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where an installed tokenizer file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text decoded from them; ``covered_bytes`` is where the last span ends."""
    encoded = pieces.encode(_table(spark, sf_dir, "documents"), tokenizer_file(PIECE_MODEL), round_trip=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("bigint").alias("covered_bytes"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back from the archives."""
    archives = warc.write_archives(_table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_archives(archives, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = private_data.find_private(docs, private_data.train(docs))
    counts = [f"n_{kind}" for kind in private_data.KINDS]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_added")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(_table(spark, sf_dir, "pages"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings that are left, named by place and digest, not by value."""
    return secret_scan.secrets(_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies.exact_copies(_table(spark, sf_dir, "documents"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose sets of three-word shingles have a similarity of 0.9 or more are in one component."""
    return near_copies.near_copies(_table(spark, sf_dir, "documents"), width=3, percent=90).select(
        "doc_id", "n_shingles", "component_id"
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(_table(spark, sf_dir, "documents"), tokenizer_file(WORD_TOKENIZER)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, after every tenth document by hash has its end made periodic."""
    return periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), rewrite=True).drop("n_words")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_warc": op2_warc,
    "op3_quality_rules": op3_quality_rules,
    "op4_pii": op4_pii,
    "op5_html_extraction": op5_html_extraction,
    "op6_secret_scan": op6_secret_scan,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_toxicity": op10_toxicity,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_sharding": op12_sharding,
    "op13_collocations": op13_collocations,
}
