"""Tables in versions: an upsert rewrites the parts that it touches, all other files stay as they are.

A row's part is a hash of an expression over its key, so one key never lives in two parts. Each version is a manifest that
names the folder of every part; readers of an older version keep their files until ``expire``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcel_comps.operators.store import last_wins, merged, upsert, with_keys
from parcel_comps.plans.checkpoints import materialize

_VERSIONS = "_versions"


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _read_text(spark: SparkSession, path: str) -> str:
    fs, at = _hadoop(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, at = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


@dataclass(frozen=True)
class VersionedTable:
    """One version of a table. ``parts`` maps a part's number to its folder below ``root``."""

    spark: SparkSession
    root: str
    keys: list[str]
    #: SQL over the key columns; rows of one value share a part, as the rows of a town do.
    by: str
    buckets: int
    schema: T.StructType
    version: int
    parts: dict[int, str]

    @classmethod
    def create(cls, rows: DataFrame, root: str, keys: list[str], by: str | None = None, buckets: int = 256) -> VersionedTable:
        """Version 0; ``rows`` must have each key once. By default parts are hashes of the whole key."""
        table = cls(rows.sparkSession, root.rstrip("/"), keys, by or f"struct({', '.join(keys)})", buckets, rows.schema, -1, {})
        return table._commit(table._write(rows))

    @classmethod
    def open(cls, spark: SparkSession, root: str, version: int | None = None) -> VersionedTable:
        """A version by number, or the latest."""
        root = root.rstrip("/")
        if version is None:
            version = max((int(n.split(".")[0]) for n in _children(spark, f"{root}/{_VERSIONS}") if n.endswith(".json")), default=None)
            if version is None:
                raise FileNotFoundError(f"no table in {root}")
        m = json.loads(_read_text(spark, f"{root}/{_VERSIONS}/{version}.json"))
        parts = {int(k): v for k, v in m["parts"].items()}
        return cls(spark, root, m["keys"], m["by"], m["buckets"], T.StructType.fromJson(m["schema"]), version, parts)

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(F.expr(self.by)), F.lit(self.buckets)).cast("int")

    def read(self, parts: list[int] | None = None) -> DataFrame:
        """The rows, or those of some parts only."""
        folders = [f"{self.root}/{f}" for n, f in sorted(self.parts.items()) if parts is None or n in set(parts)]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def _write(self, rows: DataFrame) -> dict[int, str]:
        """Write rows below a new folder; a part of any size is split by key ranges among tasks."""
        folder = f"data/{uuid.uuid4().hex}"
        order = ["_part", *self.keys]
        placed = rows.withColumn("_part", self._part()).repartitionByRange(*order).sortWithinPartitions(*order)
        placed.write.partitionBy("_part").parquet(f"{self.root}/{folder}")
        names = [n for n in _children(self.spark, f"{self.root}/{folder}") if n.startswith("_part=")]
        return {int(n.removeprefix("_part=")): f"{folder}/{n}" for n in names}

    def _commit(self, changed: dict[int, str]) -> VersionedTable:
        """The next version; raises if another writer has taken its number."""
        new = replace(self, version=self.version + 1, parts=self.parts | changed)
        manifest = {"keys": new.keys, "by": new.by, "buckets": new.buckets, "schema": json.loads(new.schema.json()), "parts": new.parts}
        fs, at = _hadoop(self.spark, f"{self.root}/{_VERSIONS}/{new.version}.json")
        if fs.exists(at):
            raise RuntimeError(f"version {new.version} of {self.root} was written meanwhile")
        # Readers look for .json names only, so they never see half a manifest.
        _, spare = _hadoop(self.spark, f"{self.root}/{_VERSIONS}/{uuid.uuid4().hex}.tmp")
        stream = fs.create(spare, False)
        try:
            stream.write(json.dumps(manifest).encode())
        finally:
            stream.close()
        if not fs.rename(spare, at):
            raise RuntimeError(f"version {new.version} of {self.root} was written meanwhile")
        return new

    def merge(
        self, updates: DataFrame, order: list[str], stamp: str | None = None, now: Column | None = None, keep: dict[str, Column] | None = None
    ) -> VersionedTable:
        """``upsert`` into the parts that the updates fall in; the table as it was if there are none.

        At most ``buckets`` part numbers reach the driver.
        """
        fresh = materialize(last_wins(with_keys(updates, self.keys), self.keys, order))
        touched = [r[0] for r in fresh.select(self._part()).distinct().collect()]
        if not touched:
            return self
        return self._commit(self._write(merged(self.read(touched), fresh, self.keys, stamp, now, keep)))

    def expire(self, versions: int = 1) -> None:
        """Forget all but the last ``versions`` versions and delete the files that none of these has."""
        kept = [VersionedTable.open(self.spark, self.root, v) for v in range(max(0, self.version - versions + 1), self.version + 1)]
        used = {f for table in kept for f in table.parts.values()}
        for name in _children(self.spark, f"{self.root}/{_VERSIONS}"):
            if name.endswith(".json") and int(name.split(".")[0]) < kept[0].version:
                fs, at = _hadoop(self.spark, f"{self.root}/{_VERSIONS}/{name}")
                fs.delete(at, False)
        for folder in _children(self.spark, f"{self.root}/data"):
            inside = [f"data/{folder}/{n}" for n in _children(self.spark, f"{self.root}/data/{folder}")]
            gone = [f"data/{folder}"] if not used & set(inside) else [p for p in inside if p.split("/")[-1].startswith("_part=") and p not in used]
            for path in gone:
                fs, at = _hadoop(self.spark, f"{self.root}/{path}")
                fs.delete(at, True)


Table = DataFrame | VersionedTable


def upsert_into(target: Table, updates: DataFrame, keys: list[str], order: list[str], **options) -> Table:
    """``upsert`` into a frame or into a stored table, whose next version comes back."""
    if isinstance(target, VersionedTable):
        if target.keys != keys:
            raise ValueError(f"the table has the key {target.keys}, not {keys}")
        return target.merge(updates, order, **options)
    return upsert(target, updates, keys, order, **options)
