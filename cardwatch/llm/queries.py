"""Registered queries of the training-data operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardwatch.llm.spark_io import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.toxicity import toxicity_scores

    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.warc import archive_round_trip

    return archive_round_trip(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.linededup import line_dedup

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_removed", "n_runs", "text_sha256")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.licenses import licence_scan

    return licence_scan(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.tokencounts import token_counts

    return token_counts(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.repetition import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.substrings import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.exactdup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.filteraudit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardwatch.llm.fim import round_trip

    return round_trip(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_decontaminate, op2_bpe_codec, op3_near_duplicates, op4_toxicity, op5_warc_merge, op6_line_dedup, op7_license_scan, op8_token_counts, op9_quality_rules, op10_substring_dedup, op11_exact_dedup, op12_filter_audit, op13_fill_in_middle)}
