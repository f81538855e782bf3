"""Where windows of a fixed length repeat: sampled anchors bring equal windows together without a row for each window.

A window's anchor is the smallest hash among its inner grams, so equal windows have equal anchors. Consecutive windows
with one anchor form a run. An anchor seen once cannot hold a repeated window. Where all runs of an anchor have the same
content, every window of them repeats. Only anchors with different runs ("branching") need their contents compared,
once for each distinct content, however many copies there are.

Rows are told apart by id and text hash, so repeated or missing ids do no harm; rows equal in both are copies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, prefix_hash, span_hash, text_buffer

#: Units of a block of rows: their values and the first unit of each row.
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
KEY = ["_id", "_text_hash"]


def window_runs(values: np.ndarray, first: np.ndarray, window: int, inner: int) -> tuple[np.ndarray, ...]:
    """Row, start in the row, number of windows, anchor and content hash of every run.

    A run ends where its anchor leaves the window, even if an equal gram follows: so equal windows are never in one run.
    """
    n, width = len(values), window - inner + 1
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if n < window:
        return none
    prefix = prefix_hash(values)
    at = np.arange(n - inner + 1)
    grams = span_hash(prefix, at, at + inner)
    low, size = grams, 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    ends = np.maximum(first[:-1], first[1:] - window + 1)
    step = np.zeros(n + 2, np.int64)
    np.add.at(step, first[:-1], 1)
    np.add.at(step, ends, -1)
    valid = np.cumsum(step)[: len(low)] > 0
    turn = np.ones(len(low) + 1, bool)
    turn[1:-1] = (low[1:] != low[:-1]) | (valid[1:] != valid[:-1]) | (grams[: len(low) - 1] == low[:-1])
    borders = np.flatnonzero(turn)
    keep = valid[borders[:-1]]
    starts, stops = borders[:-1][keep], borders[1:][keep]
    if not len(starts):
        return none
    count = stops - starts
    row = np.searchsorted(first, starts, "right") - 1
    return row, starts - first[row], count, low[starts], span_hash(prefix, starts, stops + window - 1)


def keyed(documents: DataFrame, id_col: str, text_col: str, extra: list[str] | None = None) -> DataFrame:
    """``_id``, ``_text_hash``, ``_text`` and, if asked for, a struct ``_extra`` of further columns."""
    more = [F.struct(*[F.col(f"`{c}`") for c in extra]).alias("_extra")] if extra else []
    return documents.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_text_hash"), F.col(text_col).alias("_text"), *more)


def runs(docs: DataFrame, units: Units, window: int, inner: int) -> DataFrame:
    """The runs of ``keyed`` documents: ``_id``, ``_text_hash``, ``start``, ``n``, ``anchor``, ``h``."""
    schema = docs.select(*KEY).schema.add("start", "integer").add("n", "integer").add("anchor", "long").add("h", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, at = text_buffer(batch.column(2))
            for lo, hi in blocks(at):
                values, first = units(buf[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
                row, start, n, anchor, h = window_runs(values, first, window, inner)
                if len(row):
                    keys = batch.slice(lo, hi - lo).select([0, 1]).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [*keys.columns, pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(h.view(np.int64))],
                        names=[*KEY, "start", "n", "anchor", "h"],
                    )

    return docs.select(*KEY, "_text").mapInArrow(run, schema)


def repeated_anchors(found: DataFrame) -> DataFrame:
    """The runs whose anchor occurs more than once, with ``branching``: whether its runs differ in content."""
    seen = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n"), F.min("h").alias("_lo"), F.max("h").alias("_hi"))
    seen = seen.where("_n > 1").select("anchor", (F.col("_lo") != F.col("_hi")).alias("branching"))
    return found.join(seen, "anchor")


def packed(docs: DataFrame) -> DataFrame:
    """``keyed`` documents with their texts compressed, for shuffles of whole texts."""
    others = [c for c in docs.columns if c != "_text"]
    schema = docs.select(*others).schema.add("_packed", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [press.compress(t.as_py() or b"") for t in batch["_text"].cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.select(others).columns, pa.array(texts, pa.binary())], names=[*others, "_packed"])

    return docs.mapInArrow(run, schema)


def with_marks(docs: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """Compressed documents (with ``_extra``) beside the list ``marks`` of their own rows of ``marks``, as structs without the key."""
    own = marks.groupBy(*KEY).agg(F.collect_list(F.struct(*[c for c in marks.columns if c not in KEY])).alias("marks"))
    own = own.select(F.col("_id").alias("_i"), F.col("_text_hash").alias("_h"), "marks")
    texts = packed(docs)
    return texts.join(own, texts["_id"].eqNullSafe(own["_i"]) & (texts["_text_hash"] == own["_h"]), how).drop("_i", "_h")


def branching_kinds(found: DataFrame) -> DataFrame:
    """One row for each distinct content of a branching anchor: its number of copies and the place of one of them."""
    kinds = found.where("branching").groupBy("anchor", "h").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(*KEY, "start", "n")).alias("at")
    )
    return kinds.select("at._id", "at._text_hash", "at.start", "at.n", "anchor", "h", "copies")


def repeated_spans(found: DataFrame, resolved: DataFrame) -> DataFrame:
    """``_id``, ``_text_hash``, ``start``, ``n``: consecutive starts of repeated windows.

    ``resolved`` says of a branching content (``anchor``, ``h``) which of its windows repeat: ``spans`` of ``start``, ``n``.
    """
    whole = found.where(~F.col("branching")).select(*KEY, "start", "n")
    parts = found.where("branching").drop("n").join(resolved, ["anchor", "h"])
    parts = parts.select(*KEY, F.col("start").alias("_start"), F.explode("spans").alias("_span"))
    return whole.unionByName(parts.select(*KEY, (F.col("_start") + F.col("_span.start")).alias("start"), F.col("_span.n").alias("n")))


def covered(size: int, marks: list[dict] | None, window: int) -> np.ndarray:
    """Which of ``size`` units lie in a window that starts in one of the spans."""
    step = np.zeros(size + 1, np.int64)
    for m in marks or ():
        step[m["start"]] += 1
        step[m["start"] + m["n"] + window - 1] -= 1
    return np.cumsum(step[:-1]) > 0


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

