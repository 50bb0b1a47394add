"""The registered queries of this subpackage, each beside the SQL it must agree with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padronix.llm import audit, codes, decontamination, jaccard, language, licenses, lines, mixing, pii, quality, records, simhash, toxicity
from padronix.llm.batches import shared_folder

Build = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/tokens"
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    records.write_records(table(spark, sf_dir, "documents"), folder, tokenizer, end_id=2)
    back = records.read_records(spark, folder)
    return back.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"), F.md5(F.coalesce("cleaned", F.lit(""))).alias("cleaned_md5")
    )


def op3_piece_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs, public_tokenizers.path("piece_bpe_32k.model"))
    rows = docs.select("doc_id", "text", toxicity.held_out(F.col("doc_id")).alias("held_out"))
    return language.predict_language(rows, model, keep=["doc_id", "held_out"])


def op4_anchor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_personal_data(docs, keep=["doc_id"])
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_url", "n_account", "n_secret",
        sum((F.col(f"n_{k}") for k in pii.KINDS if k != "url"), F.lit(0).cast("bigint")).alias("n_personal"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op7_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", toxicity.held_out(F.col("doc_id")).alias("held_out"))
    return toxicity.score_toxicity(rows, model, keep=["doc_id", "held_out"])


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.find_contamination(docs, items, keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        decontamination.item_digest().alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_anchor_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op12_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Build] = {
    f.__name__: f for f in (
        op1_token_records, op2_line_winnowing, op3_piece_unigrams, op4_anchor_expansion, op5_quality_rules, op6_ngram_jaccard, op7_counterfactual_toxicity,
        op8_mix_sources, op9_license_diagonals,
        op10_decontamination, op11_anchor_codes, op12_golay_simhash, op13_filter_audit,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op2_line_winnowing": lines.SQL,
    "op5_quality_rules": quality.SQL,
    "op6_ngram_jaccard": jaccard.SQL,
    "op8_mix_sources": mixing.SQL,
    "op9_license_diagonals": licenses.SQL,
    "op10_decontamination": decontamination.SQL,
    "op11_anchor_codes": codes.SQL,
    "op13_filter_audit": audit.SQL,
}
