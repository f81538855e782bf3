"""Web pages as WARC archives: a deterministic sharded writer, and a reader that checks what it reads.

Records are sorted by page id and dealt to shards by running sums of their sizes in that order, so what a shard holds
depends on the pages alone. Each task sorts whole shards, regenerates headers and digests, and writes one gzip member a
record into files that roll at a compressed size. A file is written under a temporary name and then moved to the name
that its shard and number give; a repeated task writes the same bytes again. The manifest comes last, itself by a
temporary name: readers see the files that it lists, or nothing.

Of pages with equal payloads (of ``least`` bytes or more), those with the largest id are responses, the others revisit
them; smaller payloads are all responses. A page without id revisits any equal page with id; if no equal page has one, all
are responses. Rows that repeat are records each. A null payload is empty, a null url is left out. Payloads are equal
when their SHA-1 and sizes are. A page id with more than a shard's share is spread over several shards (by url, digest and place in the
input). Further columns are not read. An empty table gives a manifest without records.

Archives go to any folder that ``pyarrow.fs`` can write from executors and driver.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.window import Window

from .common import Sent, shared_folder, stored

MANIFEST = "MANIFEST.jsonl"
FORMAT = "warc_shards"
#: What a record's headers add to its payload, for shard sizes.
HEADER_BYTES = 700
IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST_SCHEMA = "file string, records long, bytes long, sha1 string"
#: Groups of equal pages above this share of all pages are joined by a broadcast list of at most as many entries.
HOT_SHARE = 5_000


def _fs(folder: str) -> tuple[files.FileSystem, str]:
    return files.FileSystem.from_uri(folder)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _headers(fields: list[tuple[str, Any]]) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode()


def _safe(url: str | None) -> str | None:
    """The url without characters that would end a header line."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_id(page_id: int | None, digest: bytes, place: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(IDS, f'{page_id}/{digest.hex()}/{place}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, place: int, date: str) -> bytes:
    """One WARC record; ``place`` counts repeated pages of one id and payload."""
    digest = hashlib.sha1(payload).digest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest, place)), ("WARC-Date", date), ("WARC-Target-URI", _safe(url)),
        ("WARC-Payload-Digest", f"sha1:{base32(digest)}"), ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, digest, 0) if revisit else None), ("Page-Id", page_id), ("Refers-To-Page-Id", refers_to if revisit else None),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block)),
    ]
    return _headers(fields) + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as one gzip member without a time."""
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


class _Roll:
    """The files of one shard, one after another."""

    def __init__(self, folder: str, shard: int, limit: int, date: str):
        self.fs, self.root = _fs(folder)
        self.shard, self.limit, self.date = shard, limit, date
        self.done: list[dict[str, Any]] = []
        self.stream: Any = None

    def add(self, data: bytes) -> None:
        packed = member(data)
        if self.stream is not None and self.size + len(packed) > self.limit:
            self.close()
        if self.stream is None:
            self.name = f"shard-{self.shard:06d}-{len(self.done):05d}.warc.gz"
            self.spare = f"{self.root}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.stream, self.size, self.count, self.sum = self.fs.open_output_stream(self.spare, compression=None), 0, 0, hashlib.sha1()
            note = f"software: sharded writer\r\nformat: WARC File Format 1.1\r\nfile: {self.name}\r\n".encode()
            self._put(member(_headers([
                ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(IDS, self.name)}>"), ("WARC-Date", self.date), ("WARC-Filename", self.name),
                ("Content-Type", "application/warc-fields"), ("Content-Length", len(note)),
            ]) + note + b"\r\n\r\n"))
        self._put(packed)
        self.count += 1

    def _put(self, packed: bytes) -> None:
        self.stream.write(packed)
        self.sum.update(packed)
        self.size += len(packed)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.fs.move(self.spare, f"{self.root}/{self.name}")
            self.done.append({"file": self.name, "records": self.count, "bytes": self.size, "sha1": self.sum.hexdigest()})
            self.stream = None


@dataclass
class _Written(WriterCommitMessage):
    entries: list[dict[str, Any]]


class _Writer(DataSourceArrowWriter):
    """Writes rows sorted by shard; a row of tag 0 says which page the following rows of its page and digest revisit."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.limit, self.date = options["path"], int(options["filebytes"]), options["date"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        done, roll, last, place, revisit, refers_to = [], None, None, 0, False, None
        for batch in iterator:
            for shard, page_id, digest, tag, url, payload, target in zip(*(batch[c] for c in ("shard", "page_id", "digest", "tag", "url", "payload", "refers_to")), strict=True):
                shard, page_id, digest = shard.as_py(), page_id.as_py(), digest.as_py()
                if roll is None or roll.shard != shard:
                    if roll:
                        roll.close()
                        done += roll.done
                    roll, last = _Roll(self.folder, shard, self.limit, self.date), None
                if last != (page_id, digest):
                    last, place, revisit, refers_to = (page_id, digest), 0, False, None
                if tag.as_py() == 0:
                    revisit, refers_to = True, target.as_py()
                    continue
                roll.add(record(page_id, url.as_py(), payload.as_py(), refers_to, revisit, place, self.date))
                place += 1
        if roll:
            roll.close()
            done += roll.done
        return _Written(done)

    def commit(self, messages: list[WriterCommitMessage]) -> None:
        entries = sorted((e for m in messages if m is not None for e in m.entries), key=lambda e: e["file"])
        fs, root = _fs(self.folder)
        spare = f"{root}/_temporary/{MANIFEST}.{uuid.uuid4().hex}"
        with fs.open_output_stream(spare, compression=None) as out:
            for e in entries:
                out.write(json.dumps(e).encode() + b"\n")
        fs.move(spare, f"{root}/{MANIFEST}")
        fs.delete_dir(f"{root}/_temporary")

    def abort(self, messages: list[WriterCommitMessage]) -> None:
        fs, root = _fs(self.folder)
        fs.delete_dir_contents(f"{root}/_temporary", missing_dir_ok=True)


class _Source(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: Any, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer({k.lower(): v for k, v in self.options.items()})


def revisits(light: DataFrame, least: int) -> DataFrame:
    """``page_id``, ``digest``, ``refers_to`` of pages that revisit an equal one, each once."""
    counted = light.where(F.col("bytes") >= least)
    total = counted.count()
    groups = stored(counted.groupBy("digest", "bytes").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n")).where("_n > 1 and refers_to is not null"))
    # groups above this size number at most HOT_SHARE
    hot = F.col("_n") > max(1000, total // HOT_SHARE)
    few, many = groups.where(hot).drop("_n"), groups.where(~hot).drop("_n")
    names = few.select("digest").withColumn("_hot", F.lit(True))
    marked = counted.join(F.broadcast(names), "digest", "left")
    found = marked.where("_hot").drop("_hot").join(F.broadcast(few), ["digest", "bytes"])
    found = found.unionByName(marked.where("_hot is null").drop("_hot").join(many, ["digest", "bytes"]))
    return found.where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def shard_bounds(light: DataFrame, shard_bytes: int) -> list[tuple[int | None, int]]:
    """The first page id of every shard and how many parts it has, in the order of page ids (null first).

    A shard takes ids until their sizes pass the next multiple of ``shard_bytes``; the sums do not depend on how Spark
    cuts the sorted ids into partitions. Two numbers a shard reach the driver.
    """
    sized = light.groupBy("page_id").agg(F.sum(F.col("bytes") + HEADER_BYTES).alias("size"))
    ordered = stored(sized.repartitionByRange("page_id").withColumn("part", F.spark_partition_id()))
    before, at = [], 0
    for part, size in ordered.groupBy("part").agg(F.sum("size").alias("size")).orderBy("part").collect():
        before.append((part, at))
        at += size
    if not before:
        return []
    offsets = light.sparkSession.createDataFrame(before, "part int, before long")
    inside = Window.partitionBy("part").orderBy("page_id").rowsBetween(Window.unboundedPreceding, 0)
    summed = ordered.withColumn("until", F.sum("size").over(inside)).join(F.broadcast(offsets), "part")
    shard = F.floor((F.col("before") + F.col("until") - F.col("size")) / shard_bytes)
    found = summed.groupBy(shard.alias("shard")).agg(F.min(F.struct("page_id")).alias("first"), F.sum("size").alias("size")).orderBy("shard")
    return [(r["first"]["page_id"], max(1, r["size"] // shard_bytes)) for r in found.collect()]


def write_archives(
    pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least: int = 0, shard_bytes: int | None = None, file_bytes: int = 256 << 20, date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write every page as a record below ``folder``. By default a shard holds a 512th of all bytes, between 4 MB and 1 GB."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    light = stored(rows.select("page_id", "digest", F.octet_length("payload").cast("long").alias("bytes")))
    if shard_bytes is None:
        total = light.agg(F.sum(F.col("bytes") + HEADER_BYTES)).first()[0] or 0
        shard_bytes = min(max(total // 512, 4 << 20), 1 << 30)
    bounds = shard_bounds(light, shard_bytes)
    # ids of the shards' starts and the number of parts before each: two numbers a shard
    starts = np.array([b[0] for b in bounds if b[0] is not None], np.int64)
    nulls = int(bool(bounds) and bounds[0][0] is None)
    parts = np.array([b[1] for b in bounds] or [1], np.int64)
    sent = Sent(spark, (starts, nulls, np.concatenate([[0], np.cumsum(parts)])))

    @F.arrow_udf("struct<shard: int, parts: int>")
    def deal(ids: pa.Array) -> pa.Array:
        first, skipped, base = sent.value
        at = np.searchsorted(first, ids.fill_null(0).to_numpy(zero_copy_only=False), "right") - 1 + skipped
        at = np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, np.maximum(at, 0))
        return pa.StructArray.from_arrays([pa.array(base[at].astype(np.int32)), pa.array((base[at + 1] - base[at]).astype(np.int32))], names=["shard", "parts"])

    own = F.when(F.col("_at.parts") == 1, 0).otherwise(F.pmod(F.xxhash64("digest", "url", F.monotonically_increasing_id()), F.col("_at.parts")))
    dealt = rows.withColumn("_at", deal("page_id")).select(
        (F.col("_at.shard") + own.cast("int")).alias("shard"), "page_id", "digest", F.lit(1).alias("tag"), "url", "payload", F.lit(None).cast("long").alias("refers_to")
    )
    notes = revisits(light, least).withColumn("_at", deal("page_id"))
    notes = notes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_at.parts") - 1))).select(
        (F.col("_at.shard") + F.col("part")).alias("shard"), "page_id", "digest", F.lit(0).alias("tag"), F.lit(None).cast("string").alias("url"), F.lit(b"").alias("payload"), "refers_to"
    )
    shards = int(parts.sum())
    ordered = dealt.unionByName(notes).repartitionById(shards, "shard").sortWithinPartitions("shard", "page_id", "digest", "tag", "url")
    fs, root = _fs(folder)
    fs.create_dir(f"{root}/_temporary", recursive=True)
    spark.dataSource.register(_Source)
    ordered.write.format(FORMAT).mode("append").option("fileBytes", file_bytes).option("date", date).save(folder)


def _members(stream: Any) -> Iterator[tuple[bytes, bytes]]:
    """The gzip members of a file, unpacked and as they stand."""
    unpress, out, raw = zlib.decompressobj(31), [], []
    while data := stream.read(1 << 20):
        while data:
            out.append(unpress.decompress(data))
            rest = unpress.unused_data
            raw.append(data[: len(data) - len(rest)])
            if not unpress.eof:
                break
            yield b"".join(out), b"".join(raw)
            unpress, out, raw, data = zlib.decompressobj(31), [], [], rest
    if raw:
        raise ValueError("a record is cut off")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record, whose length and block digest must be right."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(fields["content-length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length does not agree with its header")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{base32(hashlib.sha1(block).digest())}":
        raise ValueError("a record's block digest does not agree with its block")
    return fields, block


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def read_archives(spark: SparkSession, folder: str, *, payloads: bool = False) -> DataFrame:
    """One row a record: ``page_id``, ``url``, ``record_type``, ``payload_bytes``, ``payload_digest`` (base32), ``refers_to``,
    ``file`` and, if asked for, ``payload`` (null for a revisit).

    Only files of the manifest are read; a file of another size, digest or record number raises, and so does a record whose
    length or digests are not those of its content.
    """
    listed = spark.read.schema(MANIFEST_SCHEMA).json(f"{folder.rstrip('/')}/{MANIFEST}")
    size = listed.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    tasks = max(1, min(size["files"], max(spark.sparkContext.defaultParallelism, size["bytes"] >> 26)))
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "file"] + ["payload"] * payloads
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * payloads
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, file string" + ", payload binary" * payloads

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(folder)
        for batch in batches:
            for entry in batch.to_pylist():
                rows, held, count, whole, read = [], 0, 0, hashlib.sha1(), 0
                with fs.open_input_stream(f"{root}/{entry['file']}", compression=None) as stream:
                    for data, raw in _members(stream):
                        whole.update(raw)
                        read += len(raw)
                        fields, block = parse(data)
                        if fields["warc-type"] == "warcinfo":
                            continue
                        count += 1
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        response = fields["warc-type"] == "response"
                        if response and (len(payload) != length or base32(hashlib.sha1(payload).digest()) != digest):
                            raise ValueError(f"{entry['file']}: a payload does not agree with its length or digest")
                        row = (_number(fields.get("page-id")), fields.get("warc-target-uri"), fields["warc-type"], length, digest, _number(fields.get("refers-to-page-id")), entry["file"])
                        rows.append((*row, payload if response else None) if payloads else row)
                        held += len(block) if payloads else 0
                        if len(rows) >= 1000 or held > 1 << 23:
                            yield packed(rows)
                            rows, held = [], 0
                if (count, read, whole.hexdigest()) != (entry["records"], entry["bytes"], entry["sha1"]):
                    raise ValueError(f"{entry['file']} is not the file that the manifest lists")
                if rows:
                    yield packed(rows)

    return listed.repartition(tasks).mapInArrow(run, schema)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives below the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
