"""What the trained classifiers share: training on all labelled rows by shards, an Adam step, scoring whole tables."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, Sent, blocks, shared_folder, text_buffer

#: Labelled rows, on average, over which one task moves the weights by itself in a round.
SHARD_ROWS = 8192
#: Moves of weights are rounded to this before they are added up.
STEP = 2.0**-20
#: Numbers of an array that are added up together, and the cells of scores in which cuts are sought.
PIECE, CELLS = 1 << 13, 4096


def training_rows(documents: DataFrame, labels: DataFrame, label: str, learn: Column, id_col: str, text_col: str) -> DataFrame:
    """``_shard``, ``_check``, ``_y``, ``_text`` of every row that may be learnt from, stored one shard after another.

    ``learn`` selects the rows that may be learnt from, by ``labels`` columns alone. Rows whose label is neither
    0 nor 1 do not count, and an id labelled twice counts once, with the larger label. Shard, order and ``_check`` (every
    fifth row) come from hashes of the id, so they depend on neither partitions nor cluster size.
    """
    usable = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1))
        .groupBy("_id").agg(F.max("_y").alias("_y"))
        .where(learn)
    )
    shards = max(1, -(-usable.count() // SHARD_ROWS))
    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(usable, "_id")
    once = rows.groupBy("_id").agg(F.first("_y").alias("_y"), F.coalesce(F.max("_text"), F.lit("")).alias("_text"))
    dealt = once.select(
        F.pmod(F.xxhash64(F.lit(1), "_id"), F.lit(shards)).cast("int").alias("_shard"),
        (F.pmod(F.xxhash64(F.lit(2), "_id"), F.lit(5)) == 4).alias("_check"), F.xxhash64("_id").alias("_order"), "_id", "_y", "_text",
    )
    path = f"{shared_folder(documents.sparkSession).rstrip('/')}/llm-{uuid.uuid4().hex}"
    placed = dealt.repartition(shards, "_shard").sortWithinPartitions("_shard", "_order", "_id").drop("_order", "_id")
    placed.write.partitionBy("_shard").parquet(path)
    return documents.sparkSession.read.schema("_check boolean, _y int, _text string, _shard int").parquet(path)


def mini_batches(batches: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Shard, text bytes, offsets and labels of up to ``rows`` rows of one shard, fewer where texts are long.

    The cuts follow the order of the rows alone, not the Arrow batches they come in.
    """
    held: list[pa.RecordBatch] = []
    shard, n, size = -1, 0, 0

    def packed() -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        buf, at = text_buffer(whole["_text"])
        return shard, buf[at[0] : at[-1]], at - at[0], whole["_y"].to_numpy(zero_copy_only=False).astype(np.float64)

    for batch in batches:
        _, at = text_buffer(batch["_text"])
        lo = 0
        for i, (own, length) in enumerate(zip(batch["_shard"].to_pylist(), np.diff(at).tolist(), strict=True)):
            if n and (own != shard or n == rows or size + length > BLOCK_BYTES):
                held.append(batch.slice(lo, i - lo))
                yield packed()
                held, lo, n, size = [], i, 0, 0
            shard, n, size = own, n + 1, size + length
        held.append(batch.slice(lo))
    if n:
        yield packed()


def summed(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over all partitions of what ``work`` returns for each: an array of ``size`` numbers, set by parameters alone.

    Every task sends pieces of its array, and each piece is added up by itself. ``work`` gives multiples of ``STEP``, so that
    sums are exact and do not depend on their order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        total = work(itertools.chain([first], batches))
        at = [lo for lo in range(0, size, PIECE) if total[lo : lo + PIECE].any()]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([total[lo : lo + PIECE].tobytes() for lo in at], pa.binary())], names=["at", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, data in zip(batch["at"].to_pylist(), batch["data"].to_pylist(), strict=True):
                own = np.frombuffer(data, np.float64)
                sums[at] = sums[at] + own if at in sums else own
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["at", "data"])

    schema = "at int, data binary"
    out = np.zeros(size)
    for r in rows.mapInArrow(run, schema).repartition("at").mapInArrow(add, schema).collect():
        own = np.frombuffer(r["data"], np.float64)
        out[r["at"] : r["at"] + len(own)] = own
    return out


def stepped(x: np.ndarray) -> np.ndarray:
    return np.round(np.asarray(x, np.float64) / STEP) * STEP


def fit(rows: DataFrame, weights: dict[str, np.ndarray], learner: Callable[[dict[str, np.ndarray]], Callable], rounds: int) -> None:
    """Move ``weights`` by ``rounds`` passes over all rows, in place.

    In a round every shard starts from the same weights and takes Adam steps over its own rows; then the moves are averaged
    (iterative parameter mixing): each row of the embeddings ``E`` over the shards that moved it, the rest over all shards by
    their rows. ``learner(weights)`` gives the function that takes one step over a mini-batch (bytes, offsets, labels).
    """
    spark, names = rows.sparkSession, sorted(weights)
    widths = [weights[k].size for k in names]
    height = len(weights["E"])

    for _ in range(rounds):
        sent = Sent(spark, weights)

        def work(batches: Iterator[pa.RecordBatch], sent: Sent = sent) -> np.ndarray:
            total = np.zeros(sum(widths) + height + 1)
            for _, group in itertools.groupby(mini_batches(batches), lambda b: b[0]):
                own = {k: v.copy() for k, v in sent.value.items()}
                step, n = learner(own), 0
                for _, buf, at, y in group:
                    step(buf, at, y)
                    n += len(y)
                lo = 0
                for k, width in zip(names, widths, strict=True):
                    move = stepped(own[k] - sent.value[k])
                    total[lo : lo + width] += move.ravel() * (1 if k == "E" else n)
                    if k == "E":
                        total[-height - 1 : -1] += move.any(axis=1)
                    lo += width
                total[-1] += n
            return total

        total = summed(rows, work, sum(widths) + height + 1)
        lo = 0
        for k, width in zip(names, widths, strict=True):
            move = total[lo : lo + width].reshape(weights[k].shape)
            by = np.maximum(total[-height - 1 : -1], 1)[:, None] if k == "E" else max(total[-1], 1)
            weights[k] = (weights[k] + move / by).astype(weights[k].dtype)
            lo += width


class Adam:
    """One Adam state for a dict of arrays."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float, decay: float = 0.0):
        self.weights, self.rate, self.decay, self.steps = weights, rate, decay, 0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, grads: dict[str, np.ndarray], at: dict[str, np.ndarray] | None = None) -> None:
        """One step; ``at`` names the rows of an array that its gradient is for, where the others stay."""
        self.steps += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for k, g in grads.items():
            w, m, v = self.weights[k], self.first[k], self.second[k]
            own = (at or {}).get(k, slice(None))
            m[own] += 0.1 * (g - m[own])
            v[own] += 0.001 * (g * g - v[own])
            w[own] -= scale * m[own] / (np.sqrt(v[own]) + 1e-8) + self.rate * self.decay * w[own]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_cells(p: np.ndarray) -> np.ndarray:
    """The cell of each probability; cells are counted over all rows."""
    return np.minimum((p * CELLS).astype(np.int64), CELLS - 1)


def best_cut(counts: np.ndarray) -> float:
    """The probability cut with the best balanced accuracy, from rows of label 0 and 1 by score cell; 0.5 without both labels."""
    total = counts.sum(axis=1)
    if not total.all():
        return 0.5
    share = counts[:, ::-1].cumsum(axis=1)[:, ::-1] / total[:, None]
    gain = share[1] - share[0]
    # cells without rows give runs of equal gain; the cut stands in the middle of the best one
    best = float(np.flatnonzero(gain == gain.max()).mean())
    return float(np.clip(best / CELLS, 0.02, 0.98))


def moved(p: np.ndarray, cut: np.ndarray | float, to: float) -> np.ndarray:
    """Probabilities shifted in log-odds, so that ``cut`` becomes ``to``."""

    def logit(x: np.ndarray) -> np.ndarray:
        return np.log(x) - np.log1p(-x)

    return sigmoid(logit(np.clip(p.astype(np.float64), 1e-9, 1 - 1e-9)) - logit(np.asarray(cut)) + logit(np.asarray(to)))


def score_table(documents: DataFrame, id_col: str, text_col: str, model: Any, score: Callable[[Any, np.ndarray, np.ndarray], np.ndarray], extra: list[str] | None = None) -> DataFrame:
    """``id_col``, ``score`` and the columns ``extra``: ``score(model, bytes, offsets)`` over blocks of whole texts.

    ``model`` has a size set by parameters alone, so it is sent to the executors once.
    """
    kept = [id_col, *(c for c in extra or [] if c != id_col)]
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_kept"), F.col(text_col).alias("_text"))
    sent = Sent(documents.sparkSession, model)
    schema = rows.select("_kept").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, at = text_buffer(batch["_text"])
            out = np.zeros(len(batch))
            for lo, hi in blocks(at):
                out[lo:hi] = score(sent.value, buf[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
            yield pa.RecordBatch.from_arrays([batch["_kept"], pa.array(out)], names=["_kept", "score"])

    return rows.mapInArrow(run, schema).select("_kept.*", "score")
