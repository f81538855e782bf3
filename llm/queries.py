"""The registered queries of the operators of this package, with the parameters they run with."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import contamination, debruijn, language, nearest, overlap, periods, pieces, quality, run_index, templates, toxicity, warc, whitening
from .common import bounded_batches, fold, table
from .oracles import ORACLES as ORACLES

#: Where the public tokenizer's model lies; a parameter of the operators.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; learnt from labelled rows outside fold 0 of 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), fold(F.col("_id"), 5) != 0)
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality; learnt from labelled rows outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"), fold(F.col("_id"), 4) != 2)
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set of 4-word shingles and its class at a similarity of 85 %."""
    found = overlap.similar_classes(table(spark, sf_dir, "documents"), n=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of templates that at least three documents have, but for the first of these."""
    kept = templates.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of repeated windows of 35 words."""
    kept = debruijn.remove_repeated_words(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated strings of 400 bytes."""
    kept = run_index.remove_long_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items it holds at a similarity of 0.8 or more."""
    found = contamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("matches") > 0).cast("int").alias("contaminated"), F.sort_array(F.col("matches.item_id")).alias("item_ids"),
        F.coalesce(F.array_max("matches.similarity"), F.lit(0.0)).alias("similarity"),
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's piece ids, and whether they spell its text again (a null text spells an empty one)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spelled = pieces.decode(pieces.encode(docs, MODEL, extra=["text"]), MODEL)
    return spelled.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.col("text")).alias("round_trip"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; learnt from rows outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs, fold(F.col("doc_id"), 4) != 2)
    found = language.predict_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest by inner product of every vector whose id is divisible by 20, among all others."""
    return nearest.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", 20)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first 32 principal components of the table, at unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32, scale=64.0, offset=1_000_000)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs of words, after a period was planted in a tenth of the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", periods.rewritten("text", "doc_id").alias("text"))
    found = periods.find_runs(docs, min_length=24, exponent=3)
    # of two exponents as exact fractions the larger one; runs come by start, then period, and the earlier one stays
    better = F.aggregate(
        F.slice("runs", F.lit(2), F.greatest(F.size("runs") - 1, F.lit(0))), F.col("runs")[0],
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
    best = F.when(F.size("runs") > 0, better)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the WARC archives tell it that it was written to."""
    folder = warc.archive_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), folder, least=0)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _bounded(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {f.__name__: _bounded(f) for f in (
    op1_toxicity, op2_ngram_jaccard, op3_line_dedup, op4_substring_dedup, op5_quality, op6_suffix_array_dedup, op7_decontamination, op8_sentencepiece, op9_language_id,
    op10_nearest_neighbours, op11_whitening, op12_periodic_runs, op13_warc,
)}
