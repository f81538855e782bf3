"""Periodic runs of words: maximal stretches that repeat a period at least ``exponent`` times.

Runs of a period ``p`` have a stretch of places whose word is that of ``p`` places on, at least ``step`` long; so
each contains a point of the grid of multiples of ``step``, which grows with ``p``: a harmonic number of points a text. From every
grid point where a few words agree with those ``p`` on, the longest common extensions to both sides give the run. Of
stretches found with several periods the smallest is kept.

Extensions come from a difference cover: only suffixes at places whose residue lies in the cover are sorted, by blocks of
as many words as the cover's modulus and then by doubling. Any two places reach cover places within less than one block,
so a few words are compared, then the least common prefix between two sorted suffixes is read from a sparse
table of minima, then the words of one last block are compared. Only texts in which some short gram of words repeats are indexed.

Many texts make one block of arrays; a longer text stands alone, and points of the grid are looked at in bounded parts.
Words are runs without ASCII white space, told apart by 64-bit hashes. Null and empty texts have no words and no runs.
Repeated rows are judged alike, each on its own. Rows without id are judged as others. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, prefix_hash, span_hash, text_buffer, word_hashes

#: Any two residues modulo 13 have a common shift into the cover.
MODULUS, COVER = 13, (0, 1, 3, 9)
#: Grid points that are looked at together.
POINTS = 1 << 19


def _shifts() -> np.ndarray:
    """For two residues, the least shift that brings both into the cover."""
    inside = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    a, b, t = np.ogrid[:MODULUS, :MODULUS, :MODULUS]
    return np.argmax(inside[a + t] & inside[b + t], axis=2)


SHIFTS = _shifts()


class Extensions:
    """Longest common extensions to the right of two places of one text. ``ends`` has each place's end of text."""

    def __init__(self, values: np.ndarray, ends: np.ndarray):
        n = len(values)
        self.values, self.ends = values, ends
        self.places = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
        self.index = np.full(n, -1, np.int64)
        self.index[self.places] = np.arange(len(self.places))
        grams = span_hash(prefix_hash(values), self.places, np.minimum(self.places + MODULUS, ends[self.places]))
        order = np.lexsort((grams, ends[self.places]))
        new = np.ones(len(order), bool)
        new[1:] = (grams[order][1:] != grams[order][:-1]) | (ends[self.places][order][1:] != ends[self.places][order][:-1])
        rank = np.empty(len(order), np.int64)
        # a rank is the first slot of all suffixes that are equal so far
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        levels = [rank]
        while True:
            ordered = rank[order]
            same = ordered[1:] == ordered[:-1]
            slots = np.flatnonzero(np.append(same, False) | np.append(False, same))
            if not len(slots):
                break
            own = order[slots]
            follower = self._ahead(own, len(levels) - 1)
            then = np.where(follower >= 0, rank[follower], -1)
            by = np.lexsort((then, rank[own]))
            own, then = own[by], then[by]
            new = np.ones(len(own), bool)
            new[1:] = (rank[own][1:] != rank[own][:-1]) | (then[1:] != then[:-1])
            order[slots] = own
            rank = rank.copy()
            rank[own] = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
            levels.append(rank)
        self.slot = rank
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            equal = (a >= 0) & (b >= 0) & (levels[k][a] == levels[k][b])
            common[equal] += 1 << k
            a[equal], b[equal] = self._ahead(a[equal], k), self._ahead(b[equal], k)
        self.minima = [common]
        while (half := 1 << (len(self.minima) - 1)) * 2 <= len(common):
            self.minima.append(np.minimum(self.minima[-1][:-half], self.minima[-1][half:]))

    def _ahead(self, suffix: np.ndarray, level: int) -> np.ndarray:
        """The sampled suffix ``2**level`` blocks further on; -1 beyond the text."""
        to = self.places[suffix] + (MODULUS << level)
        return np.where(to < self.ends[self.places[suffix]], self.index[np.minimum(to, len(self.index) - 1)], -1)

    def _walk(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many of the next ``most`` words agree, compared one by one."""
        found, going = np.zeros(len(i), np.int64), np.arange(len(i))
        most = np.minimum(most, self.ends[np.minimum(j, len(self.ends) - 1)] - j)
        for t in range(MODULUS):
            going = going[t < most[going]]
            going = going[self.values[i[going] + t] == self.values[j[going] + t]]
            if not len(going):
                break
            found[going] += 1
        return found

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from ``i`` and from ``j`` on, where ``i < j`` in one text."""
        shift = SHIFTS[i % MODULUS, j % MODULUS]
        found = self._walk(i, j, shift)
        on = np.flatnonzero((found == shift) & (j + shift < self.ends[j]))
        a, b = i[on] + shift[on], j[on] + shift[on]
        one, two = self.slot[self.index[a]], self.slot[self.index[b]]
        low, high = np.minimum(one, two), np.maximum(one, two)
        level = np.frexp(high - low)[1] - 1
        shared = np.empty(len(on), np.int64)
        for k in np.unique(level):
            here = level == k
            row = self.minima[k]
            shared[here] = np.minimum(row[low[here]], row[high[here] - (1 << k)])
        shared *= MODULUS
        a, b = a + shared, b + shared
        room = np.flatnonzero(b < self.ends[j[on]])
        last = np.zeros(len(on), np.int64)
        last[room] = self._walk(a[room], b[room], np.full(len(room), MODULUS))
        found[on] += shared + last
        return found


def _per_place(first: np.ndarray, of_text: np.ndarray) -> np.ndarray:
    return np.repeat(of_text, np.diff(first))


def runs(values: np.ndarray, first: np.ndarray, min_length: int, exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs in texts that begin at ``first`` (with a final end), by start, then period."""
    none = (np.zeros(0, np.int64),) * 3
    gram = min(max(min_length, exponent * p) - p for p in range(1, min_length + 1)) // 2
    n, sizes = len(values), np.diff(first)
    if n < min_length:
        return none
    at = np.arange(n)
    ends = _per_place(first, first[1:])
    grams = span_hash(prefix_hash(values), at, np.minimum(at + gram, n))
    # texts in which no gram repeats have no run
    whole = np.flatnonzero(at + gram <= ends)
    order = whole[np.lexsort((grams[whole], ends[whole]))]
    again = (grams[order][1:] == grams[order][:-1]) & (ends[order][1:] == ends[order][:-1])
    repeats = np.isin(first[1:], ends[order][1:][again]) & (sizes >= min_length)
    if not repeats.any():
        return none
    keep = _per_place(first, repeats)
    back = np.flatnonzero(keep)
    values, grams = values[keep], grams[keep]
    sizes = sizes[repeats]
    first = np.concatenate([[0], np.cumsum(sizes)])
    n, starts, ends = len(values), _per_place(first, first[:-1]), _per_place(first, first[1:])
    right = left = None
    periods = sizes // exponent
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(min_length, exponent * period) - period
    points = -(-(sizes[text] - period) // step)
    total = np.cumsum(points)
    found = np.zeros((0, 3), np.int64)
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] - points[lo] + POINTS, "right")))
        which = np.repeat(np.arange(lo, hi), points[lo:hi])
        i = first[text[which]] + (np.arange(len(which)) - (total[which] - points[which] - (total[lo] - points[lo]))) * step[which]
        p = period[which]
        end = ends[i]
        before = np.maximum(i - gram + 1, 0)
        after = np.minimum(i + p, n - 1)
        agrees = (i + p + gram <= end) & (grams[i] == grams[after])
        agrees |= (i - gram + 1 >= starts[i]) & (i + p + 1 <= end) & (grams[before] == grams[np.minimum(before + p, n - 1)])
        i, p = i[agrees], p[agrees]
        if len(i):
            if right is None:
                right, left = Extensions(values, ends), Extensions(values[::-1], n - starts[::-1])
            ahead = right(i, i + p)
            behind = np.zeros(len(i), np.int64)
            some = np.flatnonzero(i > starts[i])
            behind[some] = left(n - i[some] - p[some], n - i[some])
            length = ahead + behind + p
            good = length >= np.maximum(min_length, exponent * p)
            found = np.concatenate([found, np.stack([i - behind, length, p], axis=1)[good]])
            # one row for each stretch, with its smallest period
            found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
            found = found[np.append(True, (found[1:, :2] != found[:-1, :2]).any(axis=1))] if len(found) else found
        lo = hi
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return back[found[:, 0]], found[:, 1], found[:, 2]


def find_runs(documents: DataFrame, *, min_length: int = 24, exponent: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row ``id_col``, ``n_words``, ``runs`` (start, length and period in words, by start, then period), ``n_dropped`` and
    ``collapsed``: the words, joined by one space, that no run contains after its first period.

    A run has at least ``min_length`` words and ``exponent`` (2 or more) periods, and no neighbouring word continues it.
    """
    if exponent < 2 or min_length < 2 * exponent:
        raise ValueError("runs need two periods and some words")
    span = "array<struct<start: bigint, length: bigint, period: bigint>>"
    schema = documents.select(id_col).schema.add("n_words", "long")
    full = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, runs {span}, n_dropped long, collapsed string"
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, at = text_buffer(batch.column(1))
            for lo, hi in blocks(at):
                piece, bounds = buf[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
                values, first, begins, stops = word_hashes(piece, bounds)
                start, length, period = runs(values, first, min_length, exponent)
                edge = np.zeros(len(values) + 1, np.int64)
                np.add.at(edge, start + period, 1)
                np.add.at(edge, start + length, -1)
                kept = np.cumsum(edge[:-1]) == 0
                owner = np.searchsorted(first, start, "right") - 1
                spans = pa.StructArray.from_arrays([pa.array(start - first[owner]), pa.array(length), pa.array(period)], fields=list(kind))
                offsets = pa.array(np.searchsorted(owner, np.arange(hi - lo + 1)).astype(np.int32))
                data, texts, dropped = piece.tobytes(), [], []
                for i in range(hi - lo):
                    a, b = first[i], first[i + 1]
                    own = kept[a:b]
                    if own.all():
                        texts.append(b" ".join(data[bounds[i] : bounds[i + 1]].split()))
                    else:
                        texts.append(b" ".join([data[x:y] for x, y in zip(begins[a:b][own].tolist(), stops[a:b][own].tolist(), strict=True)]))
                    dropped.append(int(b - a - own.sum()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first)), pa.ListArray.from_arrays(offsets, spans), pa.array(dropped, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=[id_col, "n_words", "runs", "n_dropped", "collapsed"],
                )

    rows = documents.select(F.col(id_col), F.col(text_col).alias(f"{id_col}_text"))
    return rows.mapInArrow(run, full)


def rewritten(text: str, doc_id: str, folds: int = 10) -> F.Column:
    """The text as SQL, with a period planted from some word on in the texts of fold 0 of ``folds`` (crc32 of the id); no id, no plant.

    Of ``n`` words, those from ``a = g % n`` on repeat the first ``1 + floor((n - a) / (3 + g % 8))`` of them, where ``g`` is
    the crc32 divided by ``folds``, rounded down.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / F.lit(folds))

    def plant(words: F.Column) -> F.Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.floor((n - a) / (3 + g % 8)) + 1).cast("int")
        again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), again), F.lit(1), n), " ")

    words = F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    # inside a lambda the words are split once, not once for each use
    planted = F.transform(F.array(words), plant)[0]
    return F.when((h % folds == 0) & F.col(text).rlike(r"[^ \t\n\x0B\f\r]"), planted).otherwise(F.col(text))
