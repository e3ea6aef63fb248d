"""The corpus pipeline: filtering and cleaning stages over ``documents``, each written and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns what it keeps: rows with the columns of ``documents``, and at the end
the token counts and digests of what is left.  ``run`` applies them in turn,
writing each result to the shared folder, so a lost executor costs one stage.

Every stage works on all rows of its input and keeps clean documents as they
are.  Null and empty texts pass every filter; rows without a doc_id are kept.
Rows that repeat a doc_id and a text are one row after the near-duplicate stage;
rows that share a doc_id and differ in text go or stay together there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.bpe import encode_decode
from cardwatch.llm.decontaminate import decontaminate
from cardwatch.llm.linededup import line_dedup
from cardwatch.llm.neardup import near_duplicates
from cardwatch.llm.spark_io import table, written
from cardwatch.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; a document that had lines and has none left goes."""
    cleaned = line_dedup(docs).filter("n_removed = 0 OR n_removed < n_lines")
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8 or more): the smallest doc_id.

    The line stage cuts passages out of later copies, after which they are no
    longer alike; so the documents still here are first compared by their texts
    in ``documents``, and what is left by the texts at hand.
    """
    uncut = table(spark, sf_dir, "documents").join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    for texts in (uncut, docs):
        kept = near_duplicates(texts.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), words=5, percent=80)
        kept = written(kept.filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct(), "kept")
        other = docs.filter("doc_id IS NULL")
        docs = docs.filter("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").unionByName(other)
    with_id = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    return with_id.unionByName(docs.filter("doc_id IS NULL"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents left."""
    return encode_decode(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("near_duplicates", near_copies),
    ("decontamination", benchmark),
    ("bpe", tokens),
]

#: The stages hash, fit a model and tokenize; SQL can't express them (tests hold the run against brute force).
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
