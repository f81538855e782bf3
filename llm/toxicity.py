"""Toxicity: a convolutional text classifier over hashed word embeddings.

Words (runs of letters, digits and non-ASCII bytes, ASCII lower case) are hashed to embedding rows, whole and by their
first ``PREFIX`` bytes, so that inflected forms share what they learn; a word's embedding is the sum of both. Filters of
several widths slide over the whole text, the largest response of each is kept, and a logistic layer scores them.
It is trained on all labelled rows, in shards whose moves are averaged each round. Cuts are calibrated for each language
on every fifth text, which the weights were not trained on; the language is guessed from function words of the text itself.

Null and empty texts: no word, so the score of an all-padding text. Very long texts are scored whole. Repeated rows
get equal scores. Without two labels to learn from, every score is 0.5 shifted by nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from .common import BYTE_VALUES, Sent, class_spans, prefix_hash, span_hash, text_buffer
from .learning import CELLS, Adam, best_cut, fit, mini_batches, moved, score_cells, score_table, sigmoid, summed, training_rows

WIDTHS = (1, 2, 3)
PREFIX = 4
# Function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was on are as with his they at be this have from or by",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero",
}

_CLASSES = np.zeros(256, np.uint8)
_CLASSES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Model:
    """Weights of fixed size. ``tables`` holds, for each width and offset, the filters' response to each embedding row."""

    tables: list[list[np.ndarray]]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    languages: np.ndarray
    cuts: np.ndarray = field(default_factory=lambda: np.full(len(FUNCTION_WORDS) + 1, 0.5))


def word_rows(buf: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Both embedding rows of each word, side by side, and the first word of each text. Row 0 is padding."""
    low = _LOWER[buf]
    starts, ends, first = class_spans(low, at, _CLASSES)
    sums = prefix_hash(BYTE_VALUES[low])
    rows = np.zeros((len(starts), 2), np.int32)
    half = np.uint64(65 - bits)
    rows[:, 0] = span_hash(sums, starts, ends) >> half
    rows[:, 1] = span_hash(sums, starts, np.minimum(ends, starts + PREFIX)) >> half
    rows[:, 1] += 1 << (bits - 1)
    return np.maximum(rows, 1), first


def padded(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text followed by as many padding words as the widest filter needs."""
    pad = max(WIDTHS)
    sizes = np.diff(first) + pad
    begin = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros((begin[-1], 2), np.int32)
    out[np.arange(len(rows)) + np.repeat(begin[:-1] - first[:-1], np.diff(first))] = rows
    return out, begin


def responses(rows: np.ndarray, tables: list[list[np.ndarray]], bias: np.ndarray) -> np.ndarray:
    """Filter responses at every position: a convolution is a sum of one table look-up for each offset."""
    parts = []
    for per_offset in tables:
        total = per_offset[0][rows[:, 0]]
        total += per_offset[0][rows[:, 1]]
        for j, t in enumerate(per_offset[1:], 1):
            total[:-j] += t[rows[j:, 0]]
            total[:-j] += t[rows[j:, 1]]
        parts.append(total)
    return np.concatenate(parts, axis=1) + bias


def probabilities(model: Model, buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The uncalibrated probability of each text and the number of its language group."""
    words, first = word_rows(buf, at, int(np.log2(len(model.languages))))
    rows, begin = padded(words, first)
    # widths wider than what is left of a text would reach into the next one; the padding stands between
    pooled = np.maximum(np.maximum.reduceat(responses(rows, model.tables, model.bias), begin[:-1], axis=0), 0)
    votes = np.add.reduceat(model.languages[rows[:, 0]], begin[:-1], axis=0)
    group = np.where(votes.max(axis=1) > 0, votes.argmax(axis=1), votes.shape[1])
    return sigmoid(pooled @ model.out + model.out_bias), group


def calibrated(model: Model, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    p, group = probabilities(model, buf, at)
    return moved(p, model.cuts[group], 0.5)


def start(bits: int, dim: int, filters: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {
        "E": rng.normal(0, 0.1, (1 << bits, dim)).astype(np.float32),
        "bias": np.zeros(filters * len(WIDTHS), np.float32),
        "out": rng.normal(0.3, 0.1, filters * len(WIDTHS)).astype(np.float32),
        "out_bias": np.array([-1.0], np.float32),
    }
    for n in WIDTHS:
        w[f"F{n}"] = rng.normal(0, 0.3, (n, dim, filters)).astype(np.float32)
    return w


def language_words(bits: int) -> np.ndarray:
    languages = np.zeros((1 << bits, len(FUNCTION_WORDS)), np.float32)
    for k, words in enumerate(FUNCTION_WORDS.values()):
        buf, at = text_buffer(pa.array([words]))
        languages[word_rows(buf, at, bits)[0][:, 0], k] = 1
    return languages


def model_of(w: dict[str, np.ndarray], languages: np.ndarray) -> Model:
    tables = [[w["E"] @ w[f"F{n}"][j] for j in range(n)] for n in WIDTHS]
    return Model(tables, w["bias"], w["out"], float(w["out_bias"][0]), languages)


def train(rows: DataFrame, bits: int = 17, dim: int = 8, filters: int = 8, epochs: int = 5, seed: int = 7) -> Model:
    """Train on all ``training_rows`` (texts whole) and calibrate on those marked ``_check``; every step runs where the rows are."""
    w, languages = start(bits, dim, filters, seed), language_words(bits)
    used = rows.where("not _check")
    half = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        """Texts with each embedding row, and texts, of either label."""
        seen = np.zeros((2, half + 1))
        for _, buf, at, y in mini_batches(batches):
            words, first = word_rows(buf, at, bits)
            text = np.repeat(np.arange(len(y)), np.diff(first))
            both = np.unique(np.concatenate([text * half + words[:, 0], text * half + words[:, 1]]))
            for label in (0, 1):
                seen[label, :half] += np.bincount(both[y[both // half] == label] % half, minlength=half)
                seen[label, half] += (y == label).sum()
        return seen.ravel()

    seen = summed(used, count, 2 * (half + 1)).reshape(2, half + 1)
    n0, n1 = seen[:, half]
    if n0 and n1:
        _start_from_log_odds(w, seen[:, :half], n0, n1)
        by_class = np.array([0.5 / n0, 0.5 / n1]) * (n0 + n1)
        fit(used, w, lambda own: _stepper(own, by_class), epochs)
    model = model_of(w, languages)
    sent, groups = Sent(rows.sparkSession, model), len(model.cuts)

    def cells(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((groups, 2, CELLS))
        for _, buf, at, y in mini_batches(batches):
            p, group = probabilities(sent.value, buf, at)
            np.add.at(out, (group, y.astype(np.int64), score_cells(p)), 1)
        return out.ravel()

    counts = summed(rows.where("_check"), cells, groups * 2 * CELLS).reshape(groups, 2, CELLS)
    overall = best_cut(counts.sum(axis=0))
    for g in range(groups):
        weight = counts[g, 1].sum()
        model.cuts[g] = (weight * best_cut(counts[g]) + 20 * overall) / (weight + 20)
    return model


def _start_from_log_odds(w: dict[str, np.ndarray], seen: np.ndarray, n0: float, n1: float) -> None:
    """The first dimension of each embedding starts as the word's smoothed log-odds; the first filters read it."""
    odds = np.log((seen[1] + 0.3) / (n1 + 0.6)) - np.log((seen[0] + 0.3) / (n0 + 0.6))
    sure = (seen[0] + seen[1]) / (seen[0] + seen[1] + 3)
    w["E"][:, 0] = np.clip(odds * sure, -2, 4) / 2
    w["E"][0] = 0
    for n in WIDTHS:
        w[f"F{n}"][:, 0, : w["bias"].size // len(WIDTHS) // 2] = 1


def _stepper(w: dict[str, np.ndarray], by_class: np.ndarray) -> Callable[[np.ndarray, np.ndarray, np.ndarray], None]:
    """Cross-entropy with both classes weighted alike; gradients flow through the position of each maximum alone."""
    adam = Adam(w, 0.01)
    width = w["bias"].size // len(WIDTHS)
    bits = int(np.log2(len(w["E"])))
    place = np.zeros(len(w["E"]), np.int32)

    def step(buf: np.ndarray, at: np.ndarray, y: np.ndarray) -> None:
        every, begin = padded(*word_rows(buf, at, bits))
        # only embedding rows of these texts are looked at and moved; row 0 is padding
        place[every] = 1
        own = np.flatnonzero(place)
        place[own] = np.arange(len(own))
        rows = place[every]
        place[own] = 0
        E = w["E"][own]
        r = responses(rows, [[E @ w[f"F{n}"][j] for j in range(n)] for n in WIDTHS], w["bias"])
        pooled = np.maximum.reduceat(r, begin[:-1], axis=0)
        active = np.maximum(pooled, 0)
        error = (sigmoid(active @ w["out"] + w["out_bias"][0]) - y) * by_class[y.astype(np.int64)] / len(y)
        grads = {"out": active.T @ error + 1e-4 * w["out"], "out_bias": np.array([error.sum()])}
        back = error[:, None] * w["out"][None, :] * (pooled > 0)
        grads["bias"] = back.sum(axis=0)
        grads["E"] = np.zeros_like(E)
        peak = np.stack([begin[d] + r[begin[d] : begin[d + 1]].argmax(axis=0) for d in range(len(y))])
        for k, n in enumerate(WIDTHS):
            cols = slice(k * width, (k + 1) * width)
            # a peak in the last words of the last text reads no further than its padding
            g, top = back[:, cols], peak[:, cols]
            grads[f"F{n}"] = np.zeros_like(w[f"F{n}"])
            for j in range(n):
                hit = rows[np.minimum(top + j, len(rows) - 1)]
                grads[f"F{n}"][j] = np.einsum("bf,bfd->df", g, E[hit].sum(axis=2))
                moves = (g[:, :, None] * w[f"F{n}"][j].T[None]).reshape(-1, E.shape[1])
                np.add.at(grads["E"], hit[:, :, 0].ravel(), moves)
                np.add.at(grads["E"], hit[:, :, 1].ravel(), moves)
        grads["E"][own == 0] = 0
        adam.step(grads, {"E": own})

    return step


def score_toxicity(documents: DataFrame, labels: DataFrame, learn: Column, *, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", extra: list[str] | None = None) -> DataFrame:
    """``id_col``, ``score`` (0 to 1) and ``extra`` for every row of ``documents``.

    ``learn`` says which rows of ``labels`` (as columns ``_id`` and ``_y``) may be used; all of these are trained on.
    """
    model = train(training_rows(documents, labels, label, learn, id_col, text_col))
    return score_table(documents, id_col, text_col, model, calibrated, extra)
