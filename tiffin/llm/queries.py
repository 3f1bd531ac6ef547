"""The registered queries of this subpackage and their SQL: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import bpe, chat, classifier, conversation_repair, decontaminate, language_id, merkle, near_dup, quality_rules, substring_dedup, token_counts, token_files, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents", "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


@query("op1_token_counts")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


@query("op3_token_files")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_files(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_quality_classifier")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels", "doc_id BIGINT, quality INT, toxic INT")
    return classifier.classify(documents(spark, folder), labels)


@query("op9_decontaminate")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, folder), table(spark, folder, "benchmark", "item_id BIGINT, text STRING"))


@query("op4_near_duplicates")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, folder), size=4)


@query("op10_substring_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.without_repeats(documents(spark, folder).select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_chat_format", chat.SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return chat.digests(table(spark, folder, "conversations", "conv_id BIGINT, turn BIGINT, role STRING, text STRING"))


@query("op7_url_filter", url_filter.SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages", "page_id BIGINT, url STRING")
    outcomes = url_filter.page_outcomes(pages, table(spark, folder, "labels", "doc_id BIGINT, quality INT"))
    return url_filter.judge(pages, outcomes).drop("bad_share", "bound")


@query("op2_quality_rules")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, folder)).drop("failed_shares")


@query("op5_byte_bpe")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(documents(spark, folder), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query("op11_merkle_manifest")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(documents(spark, folder))


@query("op12_conversation_repair")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.repaired(table(spark, folder, "conversations", "conv_id BIGINT, turn BIGINT, role STRING, text STRING"))


@query("op13_language_id")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(documents(spark, folder))
