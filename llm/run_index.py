"""Long repeated byte strings by a run-length index.

Sampled anchors (``anchors``) bring together the contents in which a repeated window can lie. Each task joins whole
anchor groups into one collection, builds its Burrows-Wheeler transform, keeps it as runs with a sample at both ends of
each run (text place and length of the match with the neighbouring suffix), and streams the matching statistics of every
content from these samples: away from a sample, a match is one byte shorter for each byte further on. Where the longest
match with any other place has the window's length, that window repeats.

A group too large for one index is split by the hash of whole windows, which needs no comparison between members.

Null and empty texts have no bytes, so nothing is removed. Texts shorter than the window never match. Very long texts
are cut into runs, never into prefixes; a period makes many equal runs. Repeated rows are copies of each other and match whole.
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
from .common import BYTE_VALUES, prefix_hash, span_hash, stored

#: Bytes of one index, unless one anchor's group is larger.
INDEX_BYTES = 1 << 20
#: Contents of one anchor beyond which its windows are split by their own hash.
GROUP_CONTENTS = 5_000


def suffix_order(text: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of pieces that each end in symbol 0; equal ends are ordered by piece. Prefix doubling.

    ``text`` has symbols 0 to 256 and ``piece`` the piece of each place.
    """
    n = len(text)
    end = np.flatnonzero(text == 0)[piece]
    key = np.zeros(n, np.int64)
    place = np.arange(n)
    size = 4
    for j in range(size):
        at = np.minimum(place + j, end)
        key = (key << 9) + text[at]
    order = _argsort(key, 36)
    rank = _ranks(key[order], order)
    while True:
        # the suffixes whose rank is shared
        ordered = rank[order]
        same = ordered[1:] == ordered[:-1]
        open_ = np.zeros(n, bool)
        open_[1:] |= same
        open_[:-1] |= same
        where = np.flatnonzero(open_)
        if not len(where):
            return order, rank
        own = order[where]
        after = own + size
        second = np.where(after <= end[own], rank[np.minimum(after, n - 1)] + piece[-1] + 1, piece[own])
        bits = int(n + piece[-1] + 2).bit_length()
        key = (rank[own] << bits) + second
        inner = _argsort(key, bits + int(n).bit_length())
        order[where] = own[inner]
        key = key[inner]
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        # a new rank is the place of the first suffix that shares it
        first = np.maximum.accumulate(np.where(fresh, where, 0))
        rank[order[where]] = first
        size *= 2


def _argsort(key: np.ndarray, bits: int) -> np.ndarray:
    """Order of non-negative keys below ``2**bits``; where key and place fit into 63 bits, one plain sort gives both."""
    low = int(len(key)).bit_length()
    if bits + low > 63:
        return np.argsort(key)
    return np.sort((key << low) + np.arange(len(key))) & ((1 << low) - 1)


def _ranks(ordered: np.ndarray, order: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(len(ordered), np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(ordered)), 0))
    return rank


def matching_statistics(contents: list[np.ndarray]) -> list[np.ndarray]:
    """For each byte of each content, the length of the longest match that starts there and anywhere else too."""
    lengths = np.array([len(c) for c in contents])
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    text = np.zeros(begin[-1], np.int64)
    for c, b in zip(contents, begin, strict=False):
        text[b : b + len(c)] = c
        text[b : b + len(c)] += 1
    piece = np.repeat(np.arange(len(contents)), lengths + 1)
    order, _ = suffix_order(text, piece)
    # the transform as runs of one symbol; ends of pieces never continue a run
    before = text[order - 1]
    heads = np.ones(len(order), bool)
    heads[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
    heads = np.flatnonzero(heads)
    end = begin[1:][piece] - 1
    hashes = prefix_hash(BYTE_VALUES[np.minimum(text, 255)] + text.astype(np.uint64))
    best = np.zeros(len(text), np.int64)
    # at the first suffix of a run its match with the one above, at the last its match with the one below
    for sample, other in ((order[heads[1:]], order[heads[1:] - 1]), (order[heads[1:] - 1], order[heads[1:]])):
        length = _common(hashes, sample, other, np.minimum(end[sample] - sample, end[other] - other))
        at = np.argsort(sample)
        sample, length = sample[at], length[at]
        reach = np.zeros(len(text), np.int64)
        reach[sample] = sample + length
        # a match that starts at a sample goes on, one byte shorter at each place
        reach = np.maximum.accumulate(reach)
        np.maximum(best, reach - np.arange(len(text)), out=best)
    best = np.minimum(best, end - np.arange(len(text)))
    return [best[b : b + k] for b, k in zip(begin, lengths, strict=False)]


def _common(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of places ``a`` and ``b``, by bisection on span hashes."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while len(a) and (low < high).any():
        mid = (low + high + 1) // 2
        same = span_hash(prefix, a, a + mid) == span_hash(prefix, b, b + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def repeated_starts(contents: list[np.ndarray], copies: list[int], window: int) -> list[np.ndarray]:
    """Starts of the windows of each content that occur anywhere else; a content with copies repeats throughout."""
    out = []
    for content, n, m in zip(contents, copies, matching_statistics(contents), strict=True):
        out.append(np.arange(len(content) - window + 1) if n > 1 else np.flatnonzero(m[: len(content) - window + 1] >= window))
    return out


def _units(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUES[buf], at


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """The bytes of each content: ``anchor``, ``h``, ``copies``, ``content``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for text, marks in zip(batch["_packed"], batch["marks"], strict=True):
                data, rows = unpress.decompress(text.as_py()), marks.as_py()
                yield pa.RecordBatch.from_pydict({
                    "anchor": pa.array([m["anchor"] for m in rows], pa.int64()), "h": pa.array([m["h"] for m in rows], pa.int64()),
                    "copies": pa.array([m["copies"] for m in rows], pa.int64()),
                    "content": pa.array([data[m["start"] : m["start"] + m["n"] + window - 1] for m in rows], pa.binary()),
                })

    return texts.mapInArrow(run, "anchor long, h long, copies long, content binary")


SPANS = "array<struct<start: int, n: int>>"


def _spans(starts: np.ndarray) -> list[dict[str, int]]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    lo, hi = starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])]
    return [{"start": int(a), "n": int(b - a + 1)} for a, b in zip(lo, hi, strict=True)]


def _by_index(contents: DataFrame, window: int) -> DataFrame:
    """Contents of whole anchor groups, streamed in anchor order: an index for each ``INDEX_BYTES`` or group."""
    out = pa.schema([("anchor", pa.int64()), ("h", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())])))])

    def resolve(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        found = repeated_starts([np.frombuffer(r[3], np.uint8) for r in rows], [r[2] for r in rows], window)
        kept = [(r[0], r[1], s) for r, starts in zip(rows, found, strict=True) if (s := _spans(starts))]
        return pa.RecordBatch.from_pydict({"anchor": [k[0] for k in kept], "h": [k[1] for k in kept], "spans": [k[2] for k in kept]}, schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int, bytes]] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != last and size >= INDEX_BYTES:
                    yield resolve(rows)
                    rows, size = [], 0
                rows.append(row)
                size, last = size + len(row[3]), row[0]
        if rows:
            yield resolve(rows)

    ordered = contents.repartition("anchor").sortWithinPartitions("anchor", "h").select("anchor", "h", "copies", "content")
    return ordered.mapInArrow(run, f"anchor long, h long, spans {SPANS}")


def _by_window(contents: DataFrame, window: int) -> DataFrame:
    """For the largest groups: every window's own hash, counted, then joined back to its content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, h, copies, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = np.frombuffer(content, np.uint8)
                sums, at = prefix_hash(BYTE_VALUES[data]), np.arange(len(data) - window + 1)
                n = len(at)
                yield pa.RecordBatch.from_pydict({
                    "anchor": pa.array(np.full(n, anchor)), "h": pa.array(np.full(n, h)), "copies": pa.array(np.full(n, copies)),
                    "at": pa.array(at.astype(np.int32)), "w": pa.array(span_hash(sums, at, at + window).view(np.int64)),
                })

    windows = contents.select("anchor", "h", "copies", "content").mapInArrow(run, "anchor long, h long, copies long, at int, w long")
    seen = windows.groupBy("anchor", "w").agg(F.sum("copies").alias("_n")).where("_n > 1").drop("_n")
    one = F.struct(F.col("at").alias("start"), F.lit(1).alias("n"))
    return windows.join(seen, ["anchor", "w"]).groupBy("anchor", "h").agg(F.collect_list(one).alias("spans"))


def long_repeats(documents: DataFrame, *, window: int = 400, inner: int = 200, group_contents: int = GROUP_CONTENTS, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The keyed documents and their spans of repeated window starts (``_id``, ``_text_hash``, ``start``, ``n``)."""
    docs = anchors.keyed(documents, id_col, text_col)
    found = stored(anchors.repeated_anchors(anchors.runs(docs, _units, window, inner)))
    kinds = anchors.branching_kinds(found)
    contents = stored(_cut(anchors.with_marks(docs, kinds, "inner"), window))
    sizes = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.where(F.col("_n") > group_contents).select("anchor")
    resolved = _by_index(contents.join(large, "anchor", "left_anti"), window)
    resolved = resolved.unionByName(_by_window(contents.join(large, "anchor", "left_semi"), window))
    return docs, anchors.repeated_spans(found, resolved)


def remove_long_repeats(documents: DataFrame, *, window: int = 400, inner: int = 200, group_contents: int = GROUP_CONTENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the remaining bytes) and their ``kept_sha256``."""
    docs, spans = long_repeats(documents, window=window, inner=inner, group_contents=group_contents, id_col=id_col, text_col=text_col)
    texts = anchors.with_marks(docs, spans, "left")
    schema = documents.select(id_col).schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary").add("kept_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for text, marks in zip(batch["_packed"], batch["marks"], strict=True):
                data = np.frombuffer(unpress.decompress(text.as_py()), np.uint8)
                gone = anchors.covered(len(data), marks.as_py(), window)
                kept = data[~gone].tobytes()
                rows.append((len(data), int(gone.sum()), len(anchors.spans_of(gone)[0]), kept, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()), strict=True))],
                names=[id_col, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    return texts.mapInArrow(run, schema)
