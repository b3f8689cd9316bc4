"""Queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, codes, cotrain, decontam, mixing, periodic, pii, rules, simhash, substring, toxicity, urls, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"), narrow=True).select("doc_id", "size", "source_size", "target", "taken")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [f"n_{k}" for k in pii.PATTERNS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.formatted(chat.with_probe(_read(spark, sf_dir, "conversations"))))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(_read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.find(periodic.with_loops(_read(spark, sf_dir, "documents"))))


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_read(spark, sf_dir, "pages"), urls.rules_table(spark, urls.HOST_RULES, urls.PATTERNS))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(_read(spark, sf_dir, "embeddings")).drop("scans")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_mixing, op2_pii, op3_quality, op4_decontam, op5_toxicity, op6_chat, op7_simhash, op8_substring, op9_warc, op10_rules, op11_periodic, op12_urls, op13_codes)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing.ORACLE, "op2_pii": pii.ORACLE, "op6_chat": chat.ORACLE, "op8_substring": substring.ORACLE, "op9_warc": warc.ORACLE, "op10_rules": rules.ORACLE, "op12_urls": urls.ORACLE, "op13_codes": codes.ORACLE}
