"""One FeatureCollection read by many tasks.

A file is cut at closing braces, which Spark's text reader does at any byte range. Whether a range begins inside a string,
and how deep in brackets, follows from the quotes and brackets of all ranges before it, so a first pass counts
these for both cases. The second pass then knows every feature's borders; features that reach over ranges are put together
from their parts. A feature's place is its number in the file, however the file is split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcel_comps import schemas
from parcel_comps.plans.checkpoints import materialize

_FEATURES_KEY = re.compile(rb'"features"\s*:\s*$')
_PIECES = "file string, start long, number int, text string, sure boolean"


def _structure(buf: np.ndarray, inside: int) -> tuple[np.ndarray, int]:
    """+1 and -1 at brackets outside strings, and whether a string is open at the end."""
    quote = buf == 34
    back = buf == 92
    if back.any():
        # a quote after an odd number of backslashes is a letter
        at = np.flatnonzero(quote)
        other = np.maximum.accumulate(np.where(~back, np.arange(len(buf)), -1))
        before = np.where(at > 0, other[at - 1], -1)
        quote[at[(at - 1 - before) % 2 == 1]] = False
    strings = (np.cumsum(quote) + inside) & 1
    step = ((buf == 123) | (buf == 91)).astype(np.int8) - ((buf == 125) | (buf == 93)).astype(np.int8)
    step[strings == 1] = 0
    return step, int(strings[-1]) if len(buf) else inside


def _ranges(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """The key (``columns``) and bytes of each run of rows of one range; every row ends with the brace it was cut at."""
    for batch in batches:
        keys = list(zip(*(batch[c].to_pylist() for c in columns), strict=True))
        values = batch["value"].to_pylist()
        lo = 0
        while lo < len(keys):
            hi = lo
            while hi < len(keys) and keys[hi] == keys[lo]:
                hi += 1
            yield keys[lo], np.frombuffer(("}".join(values[lo:hi]) + "}").encode(), np.uint8)
            lo = hi


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range: whether it changes being in a string, and the depth it adds from outside and from inside one."""
    found: dict[tuple, list[int]] = {}
    for key, buf in _ranges(batches, ["file", "start"]):
        turn, *deep = found.get(key, (0, 0, 0))
        steps = [_structure(buf, inside) for inside in (0, 1)]
        deep = [deep[inside] + int(steps[inside ^ turn][0].sum(dtype=np.int64)) for inside in (0, 1)]
        found[key] = [steps[turn][1], *deep]
    if found:
        rows = [(*k, *v) for k, v in found.items()]
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["file", "start", "turn", "out_deep", "in_deep"]
        )


class _Range:
    """What the second pass knows while it walks one range."""

    def __init__(self, file: str, start: int, inside: int, depth: int):
        self.key, self.inside, self.depth = (file, start), inside, depth
        #: Whether depth 2 is the array of features; None while its opening bracket lies before the range.
        self.array: bool | None = None
        self.number, self.open = -1, [] if depth >= 3 else None
        self.rows: list[tuple] = []

    def take(self, buf: np.ndarray) -> None:
        step, self.inside = _structure(buf, self.inside)
        depth = self.depth + np.cumsum(step, dtype=np.int64)
        data = buf.tobytes()
        opens = np.flatnonzero((step == 1) & ((depth == 2) | ((depth == 3) & (buf == 123))))
        closes = np.flatnonzero((step == -1) & (depth == 2) & (buf == 125))
        begin = 0
        for at in np.sort(np.concatenate([opens, closes])).tolist():
            if step[at] == -1:
                if self.open is not None:
                    self._close(data[begin : at + 1])
            elif depth[at] == 2:
                self.array = data[at : at + 1] == b"[" and bool(_FEATURES_KEY.search(data, max(0, at - 200), at))
            elif self.array is not False:
                self.number += 1
                self.open, begin = [], at
        if self.open is not None:
            self.open.append(data[begin:])
        self.depth = int(depth[-1])

    def _close(self, last: bytes) -> None:
        self.rows.append((*self.key, self.number, b"".join([*self.open, last]).decode(), self.array is not None))
        self.open = None

    def end(self) -> list[tuple]:
        """Remaining rows: a part of a feature that goes on, and the state of the array for the ranges behind (number -2)."""
        if self.open is not None:
            self._close(b"")
        if self.array is not None:
            self.rows.append((*self.key, -2, "features" if self.array else "", True))
        return self.rows


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        types = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "start", "number", "text", "sure"])

    now = None
    for key, buf in _ranges(batches, ["file", "start", "inside", "depth"]):
        if now is None or now.key != key[:2]:
            if now:
                yield packed(now.end())
            now = _Range(*key)
        now.take(buf)
        if len(now.rows) > 1000:
            yield packed(now.rows)
            now.rows = []
    if now:
        yield packed(now.end())


def read_large_features(spark: SparkSession, files: list[str]) -> DataFrame:
    """The rows of ``read_features`` for FeatureCollection files of any size: ``properties``, ``geometry``, ``_file``, ``_pos``.

    One row for each byte range (a split of the scan) is broadcast: where it begins in strings, brackets and the features.
    """
    if not files:
        return spark.createDataFrame([], "properties string, geometry string, _file string, _pos bigint")
    lines = spark.read.option("lineSep", "}").text(files)
    cut = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    seen = materialize(cut.mapInArrow(_summaries, "file string, start long, turn long, out_deep long, in_deep long"))
    # a task may meet a range in several batches only, never in several tasks
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    began = seen.withColumn("inside", F.coalesce(F.sum("turn").over(earlier), F.lit(0)) % 2)
    deep = F.when(F.col("inside") == 0, F.col("out_deep")).otherwise(F.col("in_deep"))
    began = began.withColumn("depth", F.coalesce(F.sum(deep).over(earlier), F.lit(0))).select("file", "start", "inside", "depth")
    found = materialize(cut.join(F.broadcast(began), ["file", "start"]).select("value", "file", "start", "inside", "depth").mapInArrow(_features, _PIECES))
    # which ranges begin inside the array of features, and how many features begin before each
    last = found.where("number = -2").select("file", "start", (F.col("text") == "features").alias("_array"))
    states = began.join(last, ["file", "start"], "left").withColumn("_in", F.coalesce(F.last("_array", ignorenulls=True).over(earlier), F.lit(False)))
    states = materialize(states.select("file", "start", "_in"))
    pieces = found.where("number > -2").join(F.broadcast(states), ["file", "start"]).where("sure or _in")
    counts = pieces.where("number >= 0").groupBy("file", "start").agg(F.count(F.lit(1)).alias("_n"), F.min("number").alias("_low"))
    base = states.join(counts, ["file", "start"], "left").withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    base = base.select("file", "start", "_base", F.coalesce("_low", F.lit(0)).alias("_low"))
    # what goes on from the range before has the number of the last feature there
    place = F.col("_base") + F.when(F.col("number") < 0, -1).otherwise(F.col("number") - F.col("_low"))
    placed = pieces.join(F.broadcast(base), ["file", "start"]).select("file", "start", place.cast("bigint").alias("_pos"), "text")
    whole = placed.groupBy("file", "_pos").agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("_parts"))
    feature = F.from_json(F.array_join("_parts.text", ""), schemas.FEATURE)
    return whole.select("file", "_pos", feature.alias("f")).select(
        F.coalesce("f.properties", "f.attributes").alias("properties"), "f.geometry", F.col("file").alias("_file"), "_pos"
    )
