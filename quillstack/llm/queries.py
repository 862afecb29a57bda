"""Registered queries of the corpus operators, with production parameters and whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import oracles
from .common import table
from .decontamination import decontaminate
from .language import identify
from .line_dedup import line_dedup
from .media import read_payloads, store
from .mixing import mix
from .secrets import find_secrets
from .simhash import near_duplicates
from .substring_dedup import substring_dedup
from .token_binary import token_output
from .warc import read_archive, write_archive


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), window=20, with_text=False).drop("rk", "removed")


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_output(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1).drop("kept")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, limit=4).select("doc_id", "fingerprint", "component_id")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return identify(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).drop("rk")


def op6_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents")).drop("rk", "n_repos")


def op8_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_payloads(store(table(spark, sf_dir, "documents"))).drop("rk")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("rk")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_archive(table(spark, sf_dir, "pages"))
    return read_archive(files, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries():
    return {f.__name__: f for f in (op1_substring_dedup, op2_token_binary, op3_line_dedup, op4_simhash, op5_language_id, op6_pareto_mix, op7_secrets, op8_progressive_jpeg, op9_decontamination, op10_warc)}


def oracle_sql():
    return {"op1_substring_dedup": oracles.OP1, "op3_line_dedup": oracles.OP3, "op6_pareto_mix": oracles.OP6, "op7_secrets": oracles.OP7, "op9_decontamination": oracles.OP9, "op10_warc": oracles.OP10}
