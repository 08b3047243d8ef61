"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import bpe, fingerprint, linededup, mainpart, mixing, ngramjoin, pii, quality, secrets, sql, toxicity


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file. Its library is imported here so that the rest works without it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_mainpart(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return mainpart.extract(pages, mainpart.fit(pages), mainpart.recurring_blocks(pages))


def op4_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs))


def op6_ngramjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.classes(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.disclosing_terms(docs))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def _columns(query: Callable[[SparkSession, str], DataFrame], *names: str) -> Callable[[SparkSession, str], DataFrame]:
    """The part of a query's result that SQL can express."""
    return lambda spark, sf_dir: query(spark, sf_dir).select(*names)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    whole = {f.__name__: f for f in (op1_mixing, op2_bpe, op3_mainpart, op4_linededup, op5_secrets, op6_ngramjoin, op7_toxicity, op8_pii, op9_fingerprint, op10_quality)}
    return whole | {
        "mixing_targets": _columns(op1_mixing, "doc_id", "size", "source_size", "target"),
        "secrets_base": _columns(op5_secrets, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256"),
        "pii_base": _columns(op8_pii, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"),
        "fingerprint_base": _columns(op9_fingerprint, "doc_id", "n_chars", "edited_sha256", "near_edited", "near_next"),
        "quality_base": _columns(op10_quality, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"),
    }


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE)
