"""What several operators share: folds, shared storage, and hashing of whole Arrow batches in NumPy."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task hashes at once; its arrays take about 40 times as much.
BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
#: A random 64-bit value for each byte value, so that a sum of powers is a hash.
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse; kept in each process, never sent along."""

    def __init__(self) -> None:
        self.both = np.zeros((2, 0), np.uint64)

    def __reduce__(self) -> tuple:
        return type(self), ()

    def upto(self, n: int) -> np.ndarray:
        if self.both.shape[1] < n:
            size = 1 << max(16, int(n - 1).bit_length())
            steps = np.array([[_BASE], [pow(_BASE, -1, 1 << 64)]], np.uint64).repeat(size, axis=1)
            steps[:, 0] = 1
            self.both = np.cumprod(steps, axis=1, dtype=np.uint64)
        return self.both


_POWERS = _Powers()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch between Spark and Python: texts are long, so fewer than Spark's default of 10,000.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches small enough for two Python workers beside each executor's heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: which rows are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; local sessions without one get their own.

    A session on a cluster without that setting raises, because executors could not share a local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="spark-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: With this setting Spark deletes an action's shuffle files when it ends, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again: cuts lineage, survives lost executors.

    Nothing reads the shuffles of the write again, so their files go with it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what ``stored`` returned, once all that was made of it is stored too or not wanted any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._stored_at)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class Packed:
    """A value that was pickled on an executor; the driver passes it on without unpacking it."""

    data: bytes


class Sent:
    """A value that executors get once. It is pickled with the code of its class, so they need no copy of this package."""

    def __init__(self, spark: SparkSession, value: Any):
        self._packed = spark.sparkContext.broadcast(value.data if isinstance(value, Packed) else cloudpickle.dumps(value))

    def __getstate__(self) -> dict[str, Any]:
        return {"_packed": self._packed}

    @property
    def value(self) -> Any:
        if "_value" not in self.__dict__:
            self._value = cloudpickle.loads(self._packed.value)
        return self._value


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running sums of ``values[i] * base**i``; a difference, brought to power 0, hashes a substring."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _POWERS.upto(len(values) + 1)[0, : len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each ``[start, end)``: equal content gives equal values wherever it stands."""
    return mix((prefix[end] - prefix[start]) * _POWERS.upto(len(prefix))[1, start] + (end - start).astype(np.uint64))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its row offsets; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def blocks(at: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay below ``limit``; a longer row stands alone."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi
        lo = hi


def word_spans(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without ASCII white space in each row, and the words before each row.

    Words never cross rows; the third array has one entry more than there are rows.
    """
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = ~_WHITE[buf]
    edge = inside[1:] & ~inside[:-1]
    cut = at[(at > 0) & (at < len(buf))]
    edge[cut] |= inside[cut + 1]
    starts = np.flatnonzero(edge[:-1])
    edge = inside[:-1] & ~inside[1:]
    edge[cut] |= inside[cut]
    ends = np.flatnonzero(edge)
    return starts, ends, np.searchsorted(starts, at, "left")


def word_hashes(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, the first word of each row (with a final end), and the words' bytes."""
    starts, ends, first = word_spans(buf, at)
    prefix = prefix_hash(BYTE_VALUES[buf])
    return span_hash(prefix, starts, ends), first, starts, ends


def class_spans(buf: np.ndarray, at: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first-of-row of the maximal runs of bytes of one class other than 0, within rows."""
    kind = np.zeros(len(buf) + 2, np.uint8)
    kind[1:-1] = classes[buf]
    turn = kind[1:] != kind[:-1]
    turn[at] = True
    borders = np.flatnonzero(turn)
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    keep = kind[borders[:-1] + 1] != 0
    starts = borders[:-1][keep]
    return starts, borders[1:][keep], np.searchsorted(starts, at, "left")
