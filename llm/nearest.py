"""Approximate nearest neighbours by inner product: probed lists with an adaptive dimension scan.

Vectors are dealt to the list of their nearest centroid (k-means on a bounded sample; every row is indexed). A query
probes the lists whose centroids promise most, and further ones until these hold ``k`` candidates. In each list, vectors are rotated at random and compared block by block
of columns: after each block a hypothesis test asks whether a vector with this partial product could still reach the
k-th best found, and abandons it if not. What remains is scored exactly, in double precision, on the original vectors.

Large lists are cut into blocks, the blocks are dealt to bins, and many queries of one bin come in chunks, so no task
gets an unbounded group. A query is scanned once in each bin, over the lists that it probes there, nearest lists first.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part; nor do
rows without id. Rows that share an id are each a candidate for other ids, and one query (their smallest vector).
Equal scores go to the smaller id. With fewer than ``k`` candidates all are returned. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Sent, stored

LIST_ROWS = 500
BLOCK_ROWS = 4096
BIN_ROWS = 16_384
CHUNK_QUERIES = 2048
COLUMNS = 16
DOUBT = 3.0


@dataclass
class Index:
    """Rotation and centroids; their size is set by parameters and the vectors' length."""

    rotation: np.ndarray
    centroids: np.ndarray
    probes: int
    rows: int
    #: Rows of each list; set once all rows are dealt.
    sizes: np.ndarray | None = None


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``v``: the rows that take part."""
    v = F.col("v")
    good = F.forall(v, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & good)
    # one row for each length that occurs
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (size["d"] if size else 0))


def fit(rows: DataFrame, k: int, *, sample_rows: int = 20_000, most_lists: int = 4096, recall: float = 0.95, seed: int = 5) -> Index | None:
    """Centroids from at most ``sample_rows`` rows, and as many probes as give ``recall`` on that sample."""
    total = rows.count()
    if not total:
        return None
    sample = _matrix(rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow()["v"])
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(sample.shape[1],) * 2))[0]
    lists = int(np.clip(total // LIST_ROWS, 1, min(most_lists, len(sample))))
    centroids = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(12):
        own = nearest_centroid(sample, centroids)
        n = np.bincount(own, minlength=lists)
        sums = np.stack([np.bincount(own, column, lists) for column in sample.T], axis=1)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    own = nearest_centroid(sample, centroids)
    asked = sample[:: max(1, len(sample) // 500)]
    products = asked @ sample.T
    best = np.argsort(-products, axis=1)[:, : min(k + 1, len(sample))]
    order = np.argsort(np.argsort(-(asked @ centroids.T), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(order, own[best], axis=1).ravel())
    probes = int(needed[min(len(needed) - 1, int(recall * len(needed)))]) + 1
    return Index(rotation, centroids, probes, total)


def nearest_centroid(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(axis=1) - 2 * (x @ centroids.T), axis=1)


def scan(x: np.ndarray, ids: np.ndarray, rotated: np.ndarray, norms: np.ndarray, rows: np.ndarray, query: np.ndarray, query_id: int, rotation: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact scores of the ``k`` best of ``rows`` for one query, its own id left out."""
    d = len(query)
    q, norm = query @ rotation, np.sqrt(query @ query)
    alive = rows[ids[rows] != query_id]
    # the first rows are of the most promising list; the k-th best of them is the bar for all others
    scores = (x[alive[: 8 * k]] * query).sum(axis=1)
    bar = np.partition(scores, -k)[-k] if len(scores) >= k else -np.inf
    partial = np.zeros(len(alive))
    for at in range(0, d - COLUMNS if np.isfinite(bar) else 0, COLUMNS):
        partial += rotated[alive, at : at + COLUMNS] @ q[at : at + COLUMNS]
        done = at + COLUMNS
        # in a random basis, a product of at least ``bar`` has shown about done / d of itself by now
        slack = DOUBT * norm * norms[alive] * np.sqrt(done * (d - done) / d) / d
        kept = partial >= bar * done / d - slack
        alive, partial = alive[kept], partial[kept]
    exact = (x[alive] * query).sum(axis=1)
    order = np.lexsort((ids[alive], -exact))[:k]
    return ids[alive][order], exact[order]


def _chunks(centroids: np.ndarray, homes: dict[int, int]) -> list[tuple[int, int, int]]:
    """For each first list of some query: its chunk and over how many chunks its queries spread.

    Lists follow each other along the direction in which centroids vary most.
    """
    away = centroids - centroids.mean(axis=0)
    line = away @ np.linalg.svd(away, full_matrices=False)[2][0]
    out, at, filled = [], 0, 0
    for home in sorted(homes, key=lambda h: line[h]):
        n = homes[home]
        parts = -(-n // CHUNK_QUERIES)
        if filled and filled + n > CHUNK_QUERIES:
            at, filled = at + 1, 0
        out.append((home, at, parts))
        filled += n
        if parts > 1:
            at, filled = at + parts, 0
    return out


def search(vectors: DataFrame, is_query: str, k: int = 20, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``id_col`` and ``score`` of the ``k`` nearest found for each row where ``is_query`` (SQL) holds."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    schema = "query_id long, id long, score double"
    index = fit(rows, k)
    if index is None:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    sent = Sent(spark, index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = nearest_centroid(_matrix(batch["v"]), sent.value.centroids) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=["id", "v", "list"])

    dealt = stored(rows.mapInArrow(assign, "id long, v array<double>, list int"))
    # one row for each list: at most ``most_lists``
    sizes = dealt.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    counted = {r["list"]: r["n"] for r in sizes.collect()}
    index.sizes = np.array([counted.get(i, 0) for i in range(len(index.centroids))])
    full = Sent(spark, index)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                here = full.value
                order = np.argsort(-(_matrix(batch["v"]) @ here.centroids.T), axis=1)
                # on until there are k candidates besides the query's own rows
                reached = np.cumsum(here.sizes[order], axis=1) >= k + batch["copies"].to_numpy()[:, None]
                depth = np.where(reached.any(axis=1), reached.argmax(axis=1) + 1, order.shape[1])
                depth = np.minimum(np.maximum(depth, here.probes), order.shape[1])
                row = np.repeat(np.arange(len(batch)), depth)
                place = np.arange(len(row)) - np.repeat(np.cumsum(depth) - depth, depth)
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].take(pa.array(row)), pa.array(order[row, place].astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(order[row, 0].astype(np.int32))],
                    names=["id", "list", "order", "home"],
                )

    asked = stored(rows.where(F.expr(is_query.replace(id_col, "id"))).groupBy("id").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("copies")))
    probes = stored(asked.mapInArrow(probe, "id long, list int, order int, home int"))
    bins = max(1, -(-index.rows // BIN_ROWS))
    # queries whose first lists lie near each other share a chunk, so a chunk meets few bins
    homes = {r["home"]: r["count"] for r in probes.where("order = 0").groupBy("home").count().collect()}
    chunk_of = spark.createDataFrame(_chunks(index.centroids, homes), "home int, first int, parts int")
    bin_of = F.pmod(F.xxhash64("list", "block"), F.lit(bins)).cast("int").alias("bin")
    left = dealt.join(F.broadcast(sizes), "list").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    right = probes.join(F.broadcast(chunk_of), "home").join(F.broadcast(sizes), "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    chunk = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("chunk")
    right = right.select("id", "order", "list", bin_of, chunk).distinct().groupBy("id", "bin", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("order", "list"))).getField("list").alias("lists")
    )
    right = stored(right)
    # a vector goes to the chunks that have a query for its list; at most lists x blocks x chunks short rows say which
    met = right.select(F.col("bin").alias("bin"), F.col("chunk").alias("chunk"), F.explode("lists").alias("list")).distinct()
    left = left.select(bin_of, "id", "v", "list").join(met, ["bin", "list"]).select("bin", "chunk", "id", "v", "list")
    right = right.join(asked.select("id", "v"), "id").select("bin", "chunk", "id", "v", "lists")

    def compare(here: pa.Table, asking: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(here) and len(asking):
            lists = here["list"].to_numpy()
            by_list = np.argsort(lists, kind="stable")
            x, ids, lists = _matrix(here["v"])[by_list], here["id"].to_numpy()[by_list], lists[by_list]
            rotation = sent.value.rotation
            rotated, norms = x @ rotation, np.sqrt((x * x).sum(axis=1))
            for query_id, vector, wanted in zip(asking["id"].to_numpy(), _matrix(asking["v"]), asking["lists"].to_pylist(), strict=True):
                lo, hi = np.searchsorted(lists, wanted, "left"), np.searchsorted(lists, wanted, "right")
                rows = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi, strict=True)])
                found, scores = scan(x, ids, rotated, norms, rows, vector, query_id, rotation, k)
                out.append((np.full(len(found), query_id), found, scores))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"query_id": columns[0], "id": columns[1], "score": columns[2]})

    found = left.groupBy("bin", "chunk").cogroup(right.groupBy("bin", "chunk")).applyInArrow(compare, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
