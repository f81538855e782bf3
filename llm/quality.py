"""Quality: attention-based multiple-instance learning over the passages of a text.

A text is a bag of passages of ``PASSAGE`` tokens. A passage is encoded from the mean of its hashed token embeddings
and a few measures of its surface (case, symbols, repetition). Gated attention, learnt from document labels alone,
weighs the passages, and a logistic layer scores the weighted sum. Trained on all labelled rows, in shards whose moves are
averaged each round.

Null and empty texts are one empty passage. Very long texts are scored whole. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from .common import BYTE_VALUES, Sent, class_spans, prefix_hash, span_hash, text_buffer
from .learning import CELLS, Adam, best_cut, fit, mini_batches, moved, score_cells, score_table, sigmoid, stepped, summed, training_rows

PASSAGE = 48
MEASURES = 10

_CLASSES = np.full(256, 2, np.uint8)
_CLASSES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASSES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    mean: np.ndarray
    spread: np.ndarray
    cut: float = 0.5
    to: float = 0.5


def passages(buf: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token rows, the first token of each passage, the measures of each passage, the first passage of each text."""
    low = _LOWER[buf]
    starts, ends, first = class_spans(low, at, _CLASSES)
    rows = (span_hash(prefix_hash(BYTE_VALUES[low]), starts, ends) >> np.uint64(64 - bits)).astype(np.int32)
    sizes = np.diff(first)
    bags = np.concatenate([[0], np.cumsum(np.maximum(1, -(-sizes // PASSAGE)))])
    text = np.repeat(np.arange(len(sizes)), np.diff(bags))
    begin = first[text] + (np.arange(bags[-1]) - bags[text]) * PASSAGE
    stop = np.minimum(begin + PASSAGE, first[text + 1])
    n = np.maximum(stop - begin, 1)
    upper = np.concatenate([[0], np.cumsum((buf >= 65) & (buf <= 90))])
    length = ends - starts
    word = _CLASSES[low[starts]] == 1
    per_token = np.zeros((len(starts) + 1, 7), np.float32)
    if len(starts):
        tops = upper[ends] - upper[starts]
        per_token[:-1, 0] = word
        per_token[:-1, 1] = word & (tops == length) & (length > 1)
        per_token[:-1, 2] = ~word & (length > 1)
        per_token[:-1, 3] = np.minimum(length, 30)
        per_token[:-1, 4] = (low[starts] >= 48) & (low[starts] <= 57)
        per_token[1:-1, 5] = rows[1:] == rows[:-1]
        per_token[2:-1, 6] = rows[2:] == rows[:-2]
    total = np.concatenate([np.zeros((1, 7)), np.cumsum(per_token, axis=0, dtype=np.float64)])
    measures = np.zeros((len(begin), MEASURES), np.float32)
    measures[:, :7] = (total[stop] - total[begin]) / n[:, None]
    measures[:, 7] = (stop - begin) / PASSAGE
    order = np.lexsort((rows_in := rows, np.repeat(np.arange(len(begin)), stop - begin))) if len(rows) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(begin)), stop - begin)
    if len(order):
        new = np.ones(len(order), bool)
        new[1:] = (rows_in[order][1:] != rows_in[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        measures[:, 8] = np.bincount(owner[order][new], minlength=len(begin)) / n
    measures[:, 9] = np.log1p(sizes[text]) / 8
    return rows, np.concatenate([begin, [len(rows)]]), measures, bags


def _encode(w: dict[str, np.ndarray], model: Model, rows: np.ndarray, begin: np.ndarray, measures: np.ndarray) -> np.ndarray:
    emb = np.zeros((len(measures), w["E"].shape[1]), np.float32)
    own = np.diff(begin) > 0
    if own.any():
        emb[own] = np.add.reduceat(w["E"][rows], begin[:-1][own], axis=0) / np.diff(begin)[own, None]
    return np.concatenate([emb, (measures - model.mean) / model.spread], axis=1)


def _attend(w: dict[str, np.ndarray], x: np.ndarray, bags: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hidden passages, both gates, attention weights, bag vectors and log-odds."""
    h = np.tanh(x @ w["H"] + w["h0"])
    v, u = np.tanh(h @ w["V"]), sigmoid(h @ w["U"])
    a = (v * u) @ w["a"]
    text = np.repeat(np.arange(len(bags) - 1), np.diff(bags))
    a = np.exp(a - np.maximum.reduceat(a, bags[:-1])[text])
    a = a / np.add.reduceat(a, bags[:-1])[text]
    z = np.add.reduceat(a[:, None] * h, bags[:-1], axis=0)
    return h, v, u, a, z, z @ w["out"] + w["out0"][0]


def score_block(model: Model, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    w = model.weights
    rows, begin, measures, bags = passages(buf, at, int(np.log2(len(w["E"]))))
    logits = _attend(w, _encode(w, model, rows, begin, measures), bags)[-1]
    return moved(sigmoid(logits), model.cut, model.to)


def start(bits: int, dim: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    size = dim + MEASURES
    w = {
        "E": np.zeros((1 << bits, dim), np.float32), "H": rng.normal(0, size**-0.5, (size, hidden)), "h0": np.zeros(hidden),
        "V": rng.normal(0, hidden**-0.5, (hidden, hidden)), "U": rng.normal(0, hidden**-0.5, (hidden, hidden)),
        "a": rng.normal(0, 0.1, hidden), "out": rng.normal(0, 0.1, hidden), "out0": np.zeros(1),
    }
    w["E"] += rng.normal(0, 0.05, w["E"].shape).astype(np.float32)
    return w


def train(rows: DataFrame, to: float = 0.7, bits: int = 14, dim: int = 8, hidden: int = 16, epochs: int = 12, seed: int = 11) -> Model:
    """Train on all ``training_rows``; those marked ``_check`` only set the cut, which becomes the score ``to``."""
    model = Model(start(bits, dim, hidden, seed), np.zeros(MEASURES), np.ones(MEASURES), 0.5, to)
    used = rows.where("not _check")

    def measure(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        """Passages, the sums of their measures and of the squares, and the texts of either label."""
        out = np.zeros(2 * MEASURES + 3)
        for _, buf, at, y in mini_batches(batches):
            m = passages(buf, at, bits)[2].astype(np.float64)
            out[:MEASURES] += stepped(m).sum(axis=0)
            out[MEASURES:-3] += stepped(m * m).sum(axis=0)
            out[-3:] += len(m), (y == 0).sum(), (y == 1).sum()
        return out

    sums = summed(used, measure, 2 * MEASURES + 3)
    n, n0, n1 = sums[-3:]
    if n0 and n1:
        model.mean = sums[:MEASURES] / n
        model.spread = np.sqrt(np.maximum(sums[MEASURES:-3] / n - model.mean**2, 0)) + 0.05
        by_class = np.array([0.5 / n0, 0.5 / n1]) * (n0 + n1)
        mean, spread = model.mean, model.spread
        fit(used, model.weights, lambda own: _stepper(Model(own, mean, spread), by_class), epochs)
    sent = Sent(rows.sparkSession, model)

    def cells(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((2, CELLS))
        for _, buf, at, y in mini_batches(batches):
            np.add.at(out, (y.astype(np.int64), score_cells(sigmoid(_forward(sent.value, buf, at)[-1]))), 1)
        return out.ravel()

    model.cut = best_cut(summed(rows.where("_check"), cells, 2 * CELLS).reshape(2, CELLS))
    return model


def _forward(model: Model, buf: np.ndarray, at: np.ndarray) -> tuple:
    rows, begin, measures, bags = passages(buf, at, int(np.log2(len(model.weights["E"]))))
    x = _encode(model.weights, model, rows, begin, measures)
    return rows, begin, bags, x, *_attend(model.weights, x, bags)


def _stepper(model: Model, by_class: np.ndarray) -> Callable[[np.ndarray, np.ndarray, np.ndarray], None]:
    w = model.weights
    adam = Adam(w, 0.01)
    dim = w["E"].shape[1]

    def step(buf: np.ndarray, at: np.ndarray, y: np.ndarray) -> None:
        rows, begin, bags, x, h, v, u, a, z, logits = _forward(model, buf, at)
        text = np.repeat(np.arange(len(y)), np.diff(bags))
        error = (sigmoid(logits) - y) * by_class[y.astype(np.int64)] / len(y)
        dz = error[:, None] * w["out"]
        score = (dz[text] * h).sum(axis=1)
        da = a * (score - np.add.reduceat(a * score, bags[:-1])[text])
        dv, du = da[:, None] * w["a"] * u * (1 - v * v), da[:, None] * w["a"] * v * u * (1 - u)
        dh = (a[:, None] * dz[text] + dv @ w["V"].T + du @ w["U"].T) * (1 - h * h)
        dx = dh @ w["H"].T
        sizes = np.diff(begin)
        back = np.repeat(dx[:, :dim] / np.maximum(sizes, 1)[:, None], sizes, axis=0)
        gE = np.stack([np.bincount(rows, back[:, k], len(w["E"])) for k in range(dim)], axis=1).astype(np.float32)
        adam.step({
            "E": gE, "H": x.T @ dh + 1e-4 * w["H"], "h0": dh.sum(axis=0), "V": h.T @ dv, "U": h.T @ du,
            "a": (v * u).T @ da, "out": z.T @ error + 1e-4 * w["out"], "out0": np.array([error.sum()]),
        })

    return step


def score_quality(documents: DataFrame, labels: DataFrame, learn: Column, *, label: str = "quality", cut: float = 0.7, id_col: str = "doc_id", text_col: str = "text", extra: list[str] | None = None) -> DataFrame:
    """``id_col``, ``score`` (0 to 1) and ``extra`` for every row; the learnt cut is the score ``cut``.

    ``learn`` says which labelled rows may be used; all of these are trained on.
    """
    model = train(training_rows(documents, labels, label, learn, id_col, text_col), cut)
    return score_table(documents, id_col, text_col, model, score_block, extra)
