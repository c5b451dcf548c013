"""One query per operator of this subpackage, over the provided tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontamination, embedding_neardup, language_model, length_histogram, merkle_manifest, ngram_join, oracles, packing, personal_data, quality_rules,
    secret_scan, suffix_dedup, token_files, vector_codes,
)
from tidemark.llm.common import scratch_folder, stored
from tidemark.llm.spans import span_digest


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens, one row per piece."""
    return packing.packed_pieces(packing.pack_documents(_table(spark, folder, "documents")))


def op2_hpyp_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of all documents under a model of nine tenths of them."""
    return language_model.score_documents(_table(spark, folder, "documents"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict for every document, with a classifier fitted on the labelled ones."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = quality_rules.fit(docs, _table(spark, folder, "labels"))
    return quality_rules.score_quality(docs, model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"
    )


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return span_digest(personal_data.find_personal_data(_table(spark, folder, "documents")), personal_data.BASE_KINDS)


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals for every context limit from the histogram of all documents' encoded lengths."""
    lengths = length_histogram.token_lengths(_table(spark, folder, "documents"))
    return length_histogram.suffix_table(stored(length_histogram.length_histogram(lengths), "lengths"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return decontamination.contamination_digest(decontamination.find_contamination(docs, _table(spark, folder, "benchmark"), ["doc_id"]))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document."""
    return span_digest(secret_scan.find_secrets(_table(spark, folder, "documents")), secret_scan.BASE_KINDS)


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the strings of 50 bytes that an earlier one holds."""
    kept = suffix_dedup.remove_repeats(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents that links of a Jaccard similarity of 0.85 and more connect."""
    return ngram_join.near_duplicate_groups(_table(spark, folder, "documents"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written to token files in order of their ids, and read back."""
    place = scratch_folder(spark, "tokens")
    manifest = token_files.write_token_files(_table(spark, folder, "documents"), place)
    return token_files.token_digests(token_files.read_token_files(spark, manifest, place))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest of all documents and a proof for each, checked against texts of which half lost their line ends."""
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    claimed = {"text": F.when(marked, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    manifest = merkle_manifest.build_manifest(_table(spark, folder, "documents"), claimed=claimed)
    return manifest.proofs().select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def op12_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of embeddings of equal label that cosines of 0.93 and more connect."""
    return embedding_neardup.near_duplicates(_table(spark, folder, "embeddings"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all embeddings in 16 parts."""
    coded, _ = vector_codes.compress(_table(spark, folder, "embeddings"))
    return coded.select("vec_id", "code", "error", F.col("group_error").alias("label_error"), "codebooks_sha256")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_harmonic_packing, op2_hpyp_scores, op3_quality_rules, op4_personal_data, op5_token_counts, op6_decontamination, op7_secret_scan, op8_suffix_dedup, op9_ngram_join, op10_token_files,
             op11_merkle_manifest, op12_embedding_neardup, op13_vector_codes]
    return {fn.__name__: fn for fn in found}


def llm_oracles() -> dict[str, str]:
    """The others cannot be said in SQL over whole tables in reasonable time; tests/llm has brute-force versions."""
    return {"op12_embedding_neardup": oracles.EMBEDDING_NEARDUP, "op13_vector_codes": oracles.VECTOR_CODES}
