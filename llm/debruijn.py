"""Long repeated word spans over the edges of a de Bruijn graph.

Windows of ``window`` words are the edges of a de Bruijn graph whose nodes are the windows one word shorter. Consecutive
edges that share a sampled anchor (``anchors``) are one run. These runs stand in for compacted paths: node degrees are not
counted and path ends not joined, as what is removed depends on the edges' counts alone. Where all runs of an anchor have one
content, that stays one row through every join. Runs of other anchors are opened into their single edges,
whose multiplicities are counted and joined back; the repeated ones close into runs again. An opened run is verified
at its source coordinates: the words that stand there must give its hash. By their coordinates, runs of one text that
touch or overlap become its long repeated spans. Runs and edges are told apart by 128 bits, anchor and own hash.

Words are runs without ASCII white space, unchanged. Null and empty texts have no words. Texts shorter than the window
never match. Repeated rows are copies of each other and match whole; so do equal windows within one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors
from .common import prefix_hash, span_hash, stored, text_buffer, word_hashes


def _units(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, first, _, _ = word_hashes(buf, at)
    return hashes, first


def _word_hashes(data: bytes) -> np.ndarray:
    return word_hashes(*text_buffer(pa.array([data], pa.binary())))[0]


def _edges(texts: DataFrame, window: int) -> DataFrame:
    """The single edges of branching paths: ``anchor``, ``h`` (the path), ``copies``, ``at``, ``edge`` (hash of its words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for text, marks in zip(batch["_packed"], batch["marks"], strict=True):
                sums, rows = prefix_hash(_word_hashes(unpress.decompress(text.as_py()))), marks.as_py()
                n = np.array([m["n"] for m in rows])
                own = np.array([m["start"] for m in rows])
                if (span_hash(sums, own, own + n + window - 1).view(np.int64) != np.array([m["h"] for m in rows])).any():
                    raise ValueError("the words at a path's source coordinates are not those that were hashed")
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat([m["start"] for m in rows], n) + at
                yield pa.RecordBatch.from_pydict(
                    {k: pa.array(np.repeat(np.array([m[k] for m in rows], np.int64), n)) for k in ("anchor", "h", "copies")}
                    | {"at": pa.array(at.astype(np.int32)), "edge": pa.array(span_hash(sums, start, start + window).view(np.int64))}
                )

    return texts.mapInArrow(run, "anchor long, h long, copies long, at int, edge long")


def _reclosed(edges: DataFrame) -> DataFrame:
    """Which edges of each branching path repeat, closed into paths again: ``anchor``, ``h``, ``spans``."""
    repeated = edges.groupBy("anchor", "edge").agg(F.sum("copies").alias("_n")).where("_n > 1").drop("_n")
    places = edges.join(repeated, ["anchor", "edge"]).groupBy("anchor", "h").agg(F.sort_array(F.collect_list("at")).alias("at"))
    # an edge that does not follow the one before it starts a path; a path has at most as many edges as its anchor has places
    starts = F.filter("at", lambda x: ~F.array_contains("at", x - 1))
    ends = F.filter("at", lambda x: ~F.array_contains("at", x + 1))
    return places.select("anchor", "h", F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("n"))).alias("spans"))


def repeated_windows(documents: DataFrame, *, window: int = 35, inner: int = 6, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The keyed documents and their paths of repeated edges (``_id``, ``_text_hash``, ``start``, ``n``)."""
    docs = anchors.keyed(documents, id_col, text_col)
    found = stored(anchors.repeated_anchors(anchors.runs(docs, _units, window, inner)))
    edges = stored(_edges(anchors.with_marks(docs, anchors.branching_kinds(found), "inner"), window))
    return docs, anchors.repeated_spans(found, _reclosed(edges))


def remove_repeated_words(documents: DataFrame, *, window: int = 35, inner: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row ``id_col``, ``n_words``, ``n_removed``, ``kept`` (words joined by one space) and ``kept_sha256``."""
    docs, spans = repeated_windows(documents, window=window, inner=inner, id_col=id_col, text_col=text_col)
    texts = anchors.with_marks(docs, spans, "left")
    schema = documents.select(id_col).schema.add("n_words", "long").add("n_removed", "long").add("kept", "string").add("kept_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for text, marks in zip(batch["_packed"], batch["marks"], strict=True):
                words = unpress.decompress(text.as_py()).split()
                gone = anchors.covered(len(words), marks.as_py(), window)
                kept = b" ".join([w for w, g in zip(words, gone, strict=True) if not g] if gone.any() else words)
                rows.append((len(words), int(gone.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True))],
                names=[id_col, "n_words", "n_removed", "kept", "kept_sha256"],
            )

    return texts.mapInArrow(run, schema)
