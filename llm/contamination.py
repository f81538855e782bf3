"""Benchmark decontamination by SimHash windows and multi-index Hamming search.

Texts are words (letters, digits, non-ASCII; ASCII lower case). For each size that benchmark items have, windows of that
many words slide over every whole text; each that shares any shingle with an item of that size gets a 64-bit SimHash of
its shingles. Fingerprints are cut into blocks: two within ``RADIUS`` bits differ in at most ``RADIUS // BLOCKS`` bits
of some block, so looking up each block with that many flips finds all of them. For those the exact weighted Jaccard
similarity of the shingles (weights: how often each occurs) decides.

A text shorter than an item is one window. An item shorter than a shingle is one shingle,
like a text as short, and matches only such a text: inside longer ones it would be chance. Null or empty texts and items
match nothing. Very long texts are searched whole. Repeated rows get equal results; repeated items are each reported,
and so are items without id, with a null ``item_id``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUES, Sent, blocks, class_spans, prefix_hash, span_hash, text_buffer

BLOCKS = 8
RADIUS = 24
#: Items of one index; a larger benchmark is searched for part by part.
INDEX_ITEMS = 20_000

_CLASSES = np.zeros(256, np.uint8)
_CLASSES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: For each byte value, those at most ``RADIUS // BLOCKS`` flipped bits away.
_NEAR = [
    [v ^ sum(1 << b for b in bits) for n in range(RADIUS // BLOCKS + 1) for bits in combinations(range(8), n)] for v in range(256)
]


def shingles(buf: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash for each place where a shingle starts, the first place of each text, and each text's number of words."""
    low = _LOWER[buf]
    starts, ends, first = class_spans(low, at, _CLASSES)
    sums = prefix_hash(span_hash(prefix_hash(BYTE_VALUES[low]), starts, ends))
    words = np.diff(first)
    places = np.where(words > 0, np.maximum(words - n + 1, 1), 0)
    begin = np.concatenate([[0], np.cumsum(places)])
    text = np.repeat(np.arange(len(words)), places)
    start = first[text] + np.arange(begin[-1]) - begin[text]
    return span_hash(sums, start, np.minimum(start + n, first[text + 1])), begin, words


def fingerprints(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """SimHash of each range of shingles: a bit is set where most of them have it set."""
    bits = (hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    total = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    more = 2 * (total[stop] - total[start]) > (stop - start)[:, None]
    return (more.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


@dataclass
class SizeIndex:
    """The items of one number of shingles: sorted shingles of all, and for each block the items near each value."""

    places: int
    known: np.ndarray
    items: list[tuple[int | None, Counter]]
    prints: np.ndarray
    at: np.ndarray
    near: np.ndarray

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (fingerprint, item) pairs within the radius."""
        pairs = []
        for b in range(BLOCKS):
            value = ((prints >> np.uint64(8 * b)) & np.uint64(255)).astype(np.int64) + 256 * b
            n = self.at[value + 1] - self.at[value]
            who = np.repeat(np.arange(len(prints)), n)
            place = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.at[value], n)
            pairs.append(who * len(self.items) + self.near[place])
        pair = np.unique(np.concatenate(pairs))
        who, item = pair // len(self.items), pair % len(self.items)
        kept = np.bitwise_count(prints[who] ^ self.prints[item]) <= RADIUS
        return who[kept], item[kept]


def build_index(items: list[tuple[int, str | None]], n: int) -> list[SizeIndex]:
    by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
    buf, at = text_buffer(pa.array([t or "" for _, t in items], pa.large_string()))
    hashes, begin, _ = shingles(buf, at, n)
    for i, (item, _) in enumerate(items):
        own = hashes[begin[i] : begin[i + 1]]
        if len(own):
            by_size.setdefault(len(own), []).append((item, own))
    out = []
    for size, group in sorted(by_size.items()):
        prints = np.concatenate([fingerprints(h, np.array([0]), np.array([size])) for _, h in group])
        tables: list[list[int]] = [[] for _ in range(256 * BLOCKS)]
        for i, p in enumerate(prints.tolist()):
            for b in range(BLOCKS):
                for v in _NEAR[(p >> (8 * b)) & 255]:
                    tables[256 * b + v].append(i)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in tables])])
        out.append(SizeIndex(
            size, np.unique(np.concatenate([h for _, h in group])), [(item, Counter(h.tolist())) for item, h in group],
            prints, offsets, np.array([i for t in tables for i in t], np.int64),
        ))
    return out


def matches_in(index: list[SizeIndex], every: np.ndarray, hashes: np.ndarray, similarity: float) -> list[tuple[int, int, float]]:
    """(item, start, similarity) of the best window of each item that is similar enough, in one text's shingles."""
    hit = np.flatnonzero(every[np.minimum(np.searchsorted(every, hashes), len(every) - 1)] == hashes) if len(every) else np.zeros(0, np.int64)
    best: dict[int | tuple[int, int], tuple[float, int]] = {}
    for size in index if len(hit) else ():
        own = hit[size.known[np.minimum(np.searchsorted(size.known, hashes[hit]), len(size.known) - 1)] == hashes[hit]]
        if not len(own):
            continue
        last = max(0, len(hashes) - size.places)
        # the starts of all windows that hold one of these places
        step = np.zeros(last + 2, np.int64)
        np.add.at(step, np.maximum(np.minimum(own - size.places + 1, last), 0), 1)
        np.add.at(step, np.minimum(own, last) + 1, -1)
        start = np.flatnonzero(np.cumsum(step[:-1]) > 0)
        stop = np.minimum(start + size.places, len(hashes))
        lo = int(start[0])
        prints = fingerprints(hashes[lo : stop[-1]], start - lo, stop - lo)
        for w, i in zip(*size.candidates(prints), strict=True):
            item, wanted = size.items[i]
            # an item without id stands for itself
            item = (size.places, int(i)) if item is None else item
            found = Counter(hashes[start[w] : stop[w]].tolist())
            common = sum((found & wanted).values())
            value = common / (found.total() + wanted.total() - common)
            if value >= similarity and value > best.get(item, (0.0, 0))[0]:
                best[item] = (value, int(start[w]))
    found = [(None if isinstance(item, tuple) else item, at, value) for item, (value, at) in best.items()]
    return sorted(found, key=lambda m: (m[0] is None, m[0] or 0, *m[1:]))


def _marks(rows: DataFrame, items: list[tuple[int, str | None]], n: int, similarity: float) -> DataFrame:
    """``rows`` (``_kept``, ``_text``, ``matches``) with the matches of these items added."""
    index = build_index(items, n)
    every = np.unique(np.concatenate([s.known for s in index])) if index else np.zeros(0, np.uint64)
    sent = Sent(rows.sparkSession, (index, every))
    fields = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("similarity", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, known = sent.value
        for batch in batches:
            buf, at = text_buffer(batch["_text"])
            found = batch["matches"].to_pylist()
            for lo, hi in blocks(at):
                hashes, begin, _ = shingles(buf[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], n)
                for row, a, b in zip(range(lo, hi), begin[:-1], begin[1:], strict=True):
                    found[row] += [{"item_id": i, "start": s, "similarity": v} for i, s, v in matches_in(here, known, hashes[a:b], similarity)]
            yield pa.RecordBatch.from_arrays([batch["_kept"], batch["_text"], pa.array(found, fields)], names=["_kept", "_text", "matches"])

    return rows.mapInArrow(run, rows.schema)


def find_items(documents: DataFrame, benchmark: DataFrame, *, n: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", extra: list[str] | None = None) -> DataFrame:
    """Every row of ``documents`` (``id_col``, ``extra``) with ``matches``: the items in it, where (in shingles) and how similar."""
    kept = [id_col, *(c for c in extra or [] if c != id_col)]
    none = F.array().cast("array<struct<item_id: bigint, start: bigint, similarity: double>>")
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_kept"), F.col(text_col).alias("_text"), none.alias("matches"))
    items = benchmark.select(F.col(item_col).alias("i"), F.col(item_text).alias("t")).where("t is not null")
    parts = max(1, -(-items.count() // INDEX_ITEMS))
    for p in range(parts):
        # about INDEX_ITEMS rows at most: those of one residue
        own = items.where(F.pmod(F.when(F.col("i").isNull(), F.xxhash64("t")).otherwise(F.xxhash64("i")), F.lit(parts)) == p).orderBy("i", "t").toArrow().to_pylist()
        rows = _marks(rows, [(r["i"], r["t"]) for r in own], n, similarity)
    return rows.select("_kept.*", "matches")
