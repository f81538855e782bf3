"""The corpus pipeline: each stage works on all that the one before it kept.

Stages but the last return the columns of ``documents``, further columns included. Null or empty texts pass the
filters that need words: they hold no benchmark item and are copies of nothing. Rows without id are judged as others;
a class of equal texts without any id keeps one of them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import contamination, overlap, pieces, quality, templates
from llm.common import bounded_batches, stored, table
from llm.queries import MODEL

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def whole(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the whole row as ``_row``, so that no further column can clash."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose passages the attention model scores 0.7 or more; all labelled ones may be learnt from."""
    scored = quality.score_quality(whole(docs), table(spark, sf_dir, "labels"), F.lit(True), extra=["_row"])
    return scored.where(F.col("score") >= 0.7).select("_row.*")


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates in three or more documents go, but for the first; so do documents that lose all their words."""
    found = templates.drop_recurring_lines(whole(docs), extra=["_row"])
    left = found.where((F.col("n_removed") == 0) | F.col("kept").rlike(r"\S"))
    touched = F.col("n_removed") > 0
    now = {"text": F.when(touched, F.col("kept")), "n_chars": F.when(touched, F.length("kept").cast("long"))}
    return left.select(*[F.coalesce(now[c], F.col(f"_row.`{c}`")).alias(c) if c in now else F.col(f"_row.`{c}`") for c in docs.columns])


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of five-word shingle sets that are 80 % similar: the one with the smallest id."""
    classes = overlap.similar_classes(docs.select("doc_id", "text"), n=5, percent=80)
    # as a struct, so that nulls are equal, and whole rows move once for the join and the choice of one
    key = F.struct("doc_id", "_hash").alias("_key")
    first = classes.where("first").withColumnRenamed("text_hash", "_hash").select(key, (F.col("n_shingles") == 0).alias("_empty"))
    rows = whole(docs).withColumn("_hash", F.xxhash64(F.coalesce("text", F.lit("")))).select(key, "_row")
    first = stored(first.distinct())
    # the stored key, as Spark casts the other one to its type
    kept = rows.join(first, rows["_key"] == first["_key"]).select(first["_key"], "_row", "_empty")
    # texts without words are copies of nothing, so each of them has a number of its own
    own = F.when(F.col("_empty"), F.monotonically_increasing_id())
    return kept.withColumn("_own", own).dropDuplicates(["_key", "_own"]).select("_row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that is like a benchmark item."""
    found = contamination.find_items(whole(docs), table(spark, sf_dir, "benchmark"), extra=["_row"])
    return found.where(F.size("matches") == 0).select("_row.*")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` of what is left."""
    return pieces.encode(docs.select("doc_id", "text"), MODEL).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


def bounded(stage: Stage) -> Stage:
    """The stage with small Arrow batches, as its texts are long."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [
    ("quality", bounded(keep_good)),
    ("line_dedup", bounded(drop_recurring_lines)),
    ("ngram_jaccard", bounded(one_of_each_class)),
    ("decontamination", bounded(drop_contaminated)),
    ("sentencepiece", bounded(encode_pieces)),
]

#: Trained weights and merges are beyond SQL; tests hold the stages against brute-force versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
