"""Line dedup by a log-template tree.

A line goes down a tree of fixed depth: by its number of tokens, then by its leading tokens (a token with a digit is a
variable field). In a leaf it joins the template it agrees with most, if at least ``agreement`` of all positions agree;
positions that differ become variable fields. Templates found in at least ``min_docs`` documents are dropped from all
but the first document (smallest id) that has them.

Equal lines are one before they reach a leaf. A leaf with very many different lines is parsed in
blocks by line hash. The templates of its blocks are merged in rounds: templates that agree share the tokens of some
part of their positions, so only those that do are compared, in groups of at most two blocks. One joins the template
it agrees with most if that joins none itself; the rounds end when nothing joins. No task gets an unbounded group.

Lines end at a line feed; blank lines belong to no template and stay. Null and empty texts have no lines. Very long
lines and texts count whole. Rows equal in id and text are one document here, and lose the same lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors
from .common import BYTE_VALUES, blocks, discard, prefix_hash, span_hash, stored, text_buffer, word_spans

FIELD = 0
BLOCK_LINES = 2000
#: Longest line whose tokens are compared by 64 bits each; few positions decide there. Those of longer lines have 32.
SHORT_TOKENS = 8
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def text_lines(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines, and the first line of each text; an empty text has none."""
    stops = np.flatnonzero(buf == 10)
    full = at[1:][np.diff(at) > 0]
    ends = np.sort(np.concatenate([stops, full]))
    # a line feed at a text's very end leaves an empty line after it, as splitting does
    begins = np.sort(np.concatenate([stops + 1, at[:-1][np.diff(at) > 0]]))
    first = np.searchsorted(stops, at) + np.concatenate([[0], np.cumsum(np.diff(at) > 0)])
    return begins, ends, first


def parsed(buf: np.ndarray, at: np.ndarray, depth: int, every: bool = True) -> tuple[np.ndarray, ...]:
    """Of each line that is not blank: text, hash, number of tokens, leaf hash; and its tokens' place in all tokens.

    Unless ``every`` token is asked for, only the leading ones are hashed.
    """
    begins, ends, first = text_lines(buf, at)
    line_at = np.concatenate([begins, [len(buf)]]) if len(begins) else np.zeros(1, np.int64)
    starts, stops, own = word_spans(buf, line_at)
    size = np.diff(own)
    kept = np.flatnonzero(size > 0)
    size, own = size[kept], own[:-1][kept]
    lead = np.minimum(size, depth)
    if not every:
        words, own = _ranges(own, lead)
        starts, stops = starts[words], stops[words]
    prefix = prefix_hash(BYTE_VALUES[buf])
    tokens = span_hash(prefix, starts, stops)
    digits = np.flatnonzero(_DIGIT[buf])
    tokens = np.where(np.searchsorted(digits, stops) > np.searchsorted(digits, starts), np.uint64(FIELD), tokens | np.uint64(1))
    head = span_hash(prefix_hash(tokens + np.uint64(3)), own, own + lead)
    leaf = (head ^ (size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)
    lines = span_hash(prefix, begins[kept], ends[kept]).view(np.int64)
    text = np.searchsorted(first, kept, "right") - 1
    return text, lines, size, leaf, tokens, own


def _ranges(start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges of ``n`` from ``start``, one after the other, and where each range begins there."""
    begin = np.cumsum(n) - n
    return np.arange(int(n.sum())) + np.repeat(start - begin, n), begin


def packed_tokens(tokens: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The token hashes of each line, 32 bits of each if it is long."""
    short = np.where(tokens == FIELD, FIELD, (tokens >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)
    both = np.concatenate([np.ascontiguousarray(tokens).view(np.uint32), short])
    brief = size <= SHORT_TOKENS
    n = np.where(brief, 2 * size, size)
    at, begin = _ranges(np.where(brief, 2 * start, 2 * len(tokens) + start), n)
    offsets = np.concatenate([4 * begin, [4 * len(at)]]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(both[at])])


def unpacked_tokens(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, np.uint64 if size <= SHORT_TOKENS else np.uint32)


def document_lines(docs: DataFrame, depth: int, with_tokens: bool) -> DataFrame:
    """One row for each document and different line: key, ``line``, ``leaf``, and if asked for ``size``, ``tokens`` (packed hashes, 0 a field)."""
    schema = docs.select(*anchors.KEY).schema.add("line", "long").add("leaf", "long")
    if with_tokens:
        schema = schema.add("size", "integer").add("tokens", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, at = text_buffer(batch.column(2))
            for lo, hi in blocks(at):
                text, line, size, leaf, tokens, start = parsed(buf[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], depth, with_tokens)
                if not len(text):
                    continue
                order = np.lexsort((line, text))
                new = np.ones(len(order), bool)
                new[1:] = (text[order][1:] != text[order][:-1]) | (line[order][1:] != line[order][:-1])
                pick = order[new]
                keys = batch.slice(lo, hi - lo).select([0, 1]).take(pa.array(text[pick]))
                columns = [*keys.columns, pa.array(line[pick]), pa.array(leaf[pick])]
                if with_tokens:
                    columns += [pa.array(size[pick], pa.int32()), packed_tokens(tokens, start[pick], size[pick])]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def cluster(lines: np.ndarray, agreement: float) -> tuple[np.ndarray, np.ndarray]:
    """The template number of each row of ``lines`` (token hashes, in order) and the templates, variable fields 0."""
    templates = np.zeros((max(4, len(lines)), lines.shape[1]), lines.dtype)
    own, n = np.zeros(len(lines), np.int64), 0
    for i, line in enumerate(lines):
        if n:
            agree = (templates[:n] == line).sum(axis=1)
            best = int(agree.argmax())
            if agree[best] >= agreement * len(line):
                templates[best][templates[best] != line] = FIELD
                own[i] = best
                continue
        templates[n] = line
        own[i], n = n, n + 1
    return own, templates[:n]


def _template_id(leaf: int, template: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(leaf.to_bytes(8, "little", signed=True) + template.tobytes(), digest_size=8).digest(), "little", signed=True)


def _clustered(rows: DataFrame, agreement: float, group: list[str]) -> DataFrame:
    """``item``, ``template`` (an id) and ``fields`` (the template) of the rows (``leaf``, ``item``, ``docs``, ``size``, ``tokens``) of each group."""

    def run(part: pa.Table) -> pa.Table:
        items, sizes, tokens = part["item"].to_numpy(), part["size"].to_numpy(), part["tokens"].to_pylist()
        order = np.lexsort((items, -part["docs"].to_numpy()))
        leaf = part["leaf"][0].as_py()
        ids, fields = np.zeros(len(order), np.int64), [b""] * len(order)
        # lines of one leaf have one length, but for colliding hashes
        for size in np.unique(sizes).tolist():
            mine = [i for i in order if sizes[i] == size]
            own, found = cluster(np.stack([unpacked_tokens(tokens[i], size) for i in mine]), agreement)
            named = [_template_id(leaf, t) for t in found]
            for i, k in zip(mine, own, strict=True):
                ids[i], fields[i] = named[k], found[k].tobytes()
        return pa.table({"item": items, "template": ids, "fields": pa.array(fields, pa.binary()), "leaf": part["leaf"], "docs": part["docs"], "size": part["size"]})

    return rows.groupBy(*group).applyInArrow(run, "item long, template long, fields binary, leaf long, docs long, size int")


def position_parts(size: int, agreement: float, depth: int) -> list[np.ndarray]:
    """The positions after the leading tokens in one part more than may differ: lines that agree share a whole part."""
    differ = size
    while size - differ < agreement * size:
        differ -= 1
    return np.array_split(np.arange(min(depth, size), size), differ + 1)


def shared_parts(templates: DataFrame, agreement: float, depth: int, block_lines: int) -> DataFrame:
    """Groups (``key``, ``p``, ``q``) of the rows of ``templates`` that share a part: ``item`` and columns.

    A group is blocks ``p`` and ``q`` of what has one key; every two rows with one key are together in some group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            items, keys = [], []
            for leaf, item, size, data in zip(*(batch[c].to_pylist() for c in ("leaf", "item", "size", "tokens")), strict=True):
                if size not in cuts:
                    cuts[size] = position_parts(size, agreement, depth)
                tokens = unpacked_tokens(data, size)
                for j, at in enumerate(cuts[size]):
                    items.append(item)
                    keys.append(_template_id(leaf, np.concatenate([np.array([size, j], np.uint64), tokens[at].astype(np.uint64)])))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(keys, pa.int64())], names=["item", "key"])

    keys = templates.select("leaf", "item", "size", "tokens").mapInArrow(run, "item long, key long")
    many = keys.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").withColumn("_blocks", F.ceil(F.col("_n") / block_lines))
    block = keys.join(many, "key").withColumn("block", F.pmod(F.xxhash64("item", "key"), "_blocks"))
    # a single block is a group; of several, each two are one
    other = F.when(F.col("_blocks") == 1, F.array("block")).otherwise(F.filter(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1), lambda b: b != F.col("block")))
    paired = block.withColumn("_o", F.explode(other)).select("key", "item", F.least("block", "_o").alias("p"), F.greatest("block", "_o").alias("q"))
    return paired.join(templates.select("item", "docs", "size", "tokens"), "item")


def _key_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each group (``key``, ``p``, ``q``) of sorted batches."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("key", "p", "q", "item", "docs", "size", "tokens")), strict=True):
            if row[:3] != key:
                if len(rows) > 1:
                    yield rows
                key, rows = row[:3], []
            rows.append(row[3:])
    if len(rows) > 1:
        yield rows


def joins(templates: DataFrame, agreement: float, depth: int, block_lines: int) -> DataFrame:
    """Of each template that agrees with one before it (more ``docs``, smaller ``item``): the best, ``to``, and the positions that differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _key_groups(batches):
            out: list[tuple] = []
            rows.sort(key=lambda r: (-r[1], r[0]))
            for size in {r[2] for r in rows}:
                mine = [r for r in rows if r[2] == size]
                tokens = np.stack([unpacked_tokens(r[3], size) for r in mine])
                for i in range(1, len(mine)):
                    agree = (tokens[:i] == tokens[i]).sum(axis=1)
                    best = int(agree.argmax())
                    if agree[best] >= agreement * size:
                        out.append((mine[i][0], mine[i][1], int(-agree[best]), -mine[best][1], mine[best][0], np.flatnonzero(tokens[best] != tokens[i]).tolist()))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.list_(pa.int32()))], names=["item", "own", "agree", "docs", "to", "differ"]
                )

    groups = shared_parts(templates, agreement, depth, block_lines).select("key", "p", "q", "item", "docs", "size", "tokens")
    found = groups.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q").mapInArrow(run, "item long, own long, agree long, docs long, to long, differ array<int>")
    best = found.groupBy("item", "own").agg(F.min(F.struct("agree", "docs", "to", "differ")).alias("m"))
    return best.select("item", "own", "m.to", "m.differ")


def _with_fields(templates: DataFrame) -> DataFrame:
    """``templates`` with the positions ``fields`` (null: none) variable."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = []
            for data, size, fields in zip(*(batch[c].to_pylist() for c in ("tokens", "size", "fields")), strict=True):
                now = unpacked_tokens(data, size).copy()
                now[fields or []] = FIELD
                tokens.append(now.tobytes())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("leaf", "item", "docs", "size")), pa.array(tokens, pa.binary())], names=["leaf", "item", "docs", "size", "tokens"])

    return templates.mapInArrow(run, "leaf long, item long, docs long, size int, tokens binary")


def merged_templates(templates: DataFrame, agreement: float, depth: int, block_lines: int) -> DataFrame:
    """``item`` and ``merged`` (the template it has become) of ``templates`` (``leaf``, ``item``, ``docs``, ``size``, ``tokens``)."""
    now = stored(templates)
    named = now.select("item", F.col("item").alias("merged"))
    while True:
        best = stored(joins(now, agreement, depth, block_lines))
        if best.isEmpty():
            return named
        # the first one that joins any joins one that stays, so each round merges something
        moves = stored(best.join(best.select(F.col("item").alias("to")), "to", "left_anti"))
        each = moves.select("to", "own", F.posexplode_outer("differ").alias("_i", "_at"))
        grown = each.groupBy("to").agg(F.sum(F.when(F.coalesce("_i", F.lit(0)) == 0, F.col("own"))).alias("_more"), F.collect_set("_at").alias("fields"))
        left = now.join(moves.select("item"), "item", "left_anti").join(grown.withColumnRenamed("to", "item"), "item", "left")
        now = stored(_with_fields(left.select("leaf", "item", (F.col("docs") + F.coalesce("_more", F.lit(0))).alias("docs"), "size", "tokens", "fields")))
        step = moves.select(F.col("item").alias("merged"), "to")
        named = stored(named.join(step, "merged", "left").select("item", F.coalesce("to", "merged").alias("merged")))


def recurring_lines(docs: DataFrame, *, min_docs: int, agreement: float, depth: int, block_lines: int) -> DataFrame:
    """Key and ``line`` of what goes: lines of recurring templates, outside the first document of each."""
    # tokens are parsed anew rather than stored with each document's lines
    lines = stored(document_lines(docs, depth, False))
    different = document_lines(docs, depth, True).groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("docs"), *[F.first(c).alias(c) for c in ("size", "tokens")])
    sizes = different.groupBy("leaf").agg(F.count(F.lit(1)).alias("_n"), F.sum("docs").alias("_docs")).where(F.col("_docs") >= min_docs)
    different = stored(different.join(sizes, "leaf"))
    hot = F.col("_n") > block_lines
    # one line, or leading tokens and nothing else: the leaf is the template
    sole = (F.col("_n") == 1) | (F.col("size") <= depth)
    plain = different.where(sole).select("line", F.col("leaf").alias("template"))
    placed = different.where(~sole).select("leaf", F.col("line").alias("item"), "docs", "size", "tokens", hot.alias("hot"), F.ceil(F.col("_n") / block_lines).alias("blocks"))
    blocked = placed.where("hot").withColumn("block", F.pmod(F.xxhash64("item"), "blocks"))
    calm = _clustered(placed.where("not hot"), agreement, ["leaf"]).select(F.col("item").alias("line"), "template")
    part = stored(_clustered(blocked, agreement, ["leaf", "block"]))
    merged = part.groupBy("leaf", F.col("template").alias("item")).agg(F.sum("docs").alias("docs"), F.first("size").alias("size"), F.first("fields").alias("tokens"))
    merged = merged_templates(merged.select("leaf", "item", "docs", "size", "tokens"), agreement, depth, block_lines)
    split = part.join(merged, part["template"] == merged["item"]).select(part["item"].alias("line"), F.col("merged").alias("template"))
    named = plain.unionByName(calm).unionByName(split).join(different.select("line", "docs"), "line")
    enough = named.groupBy("template").agg(F.sum("docs").alias("_docs")).where(F.col("_docs") >= min_docs).select("template")
    places = stored(lines.select(*anchors.KEY, "line").join(named.select("line", "template").join(enough, "template"), "line"))
    discard(lines, different, part)
    first = places.select("template", *anchors.KEY).distinct().groupBy("template").agg(F.count(F.lit(1)).alias("_docs"), F.min(F.struct(*anchors.KEY)).alias("first"))
    first = first.where(F.col("_docs") >= min_docs).select("template", "first")
    return places.join(first, "template").where(~F.struct(*anchors.KEY).eqNullSafe(F.col("first"))).select(*anchors.KEY, "line")


def drop_recurring_lines(documents: DataFrame, *, min_docs: int = 3, agreement: float = 0.7, depth: int = 2, block_lines: int = BLOCK_LINES, id_col: str = "doc_id", text_col: str = "text", extra: list[str] | None = None) -> DataFrame:
    """For every row ``id_col``, ``n_lines``, ``n_removed``, ``kept`` (its remaining lines) and the columns ``extra``."""
    docs = anchors.keyed(documents, id_col, text_col, extra)
    gone = recurring_lines(docs.select(*anchors.KEY, "_text"), min_docs=min_docs, agreement=agreement, depth=depth, block_lines=block_lines)
    texts = anchors.with_marks(docs, gone, "left")
    others = [c for c in docs.columns if c not in ("_text_hash", "_text")]
    schema = docs.select(*others).schema.add("n_lines", "long").add("n_removed", "long").add("kept", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, marks in zip(batch["_packed"], batch["marks"], strict=True):
                data = unpress.decompress(text.as_py())
                n_lines = data.count(b"\n") + 1 if data else 0
                out = {m["line"] for m in marks.as_py() or ()}
                if out:
                    lines = data.split(b"\n") if data else []
                    buf, at = text_buffer(pa.array([data], pa.binary()))
                    begins, ends, _ = text_lines(buf, at)
                    hashes = span_hash(prefix_hash(BYTE_VALUES[buf]), begins, ends).view(np.int64).tolist()
                    stay = [x for x, h in zip(lines, hashes, strict=True) if h not in out or not x.strip(b" \t\r\x0b\x0c")]
                    data = b"\n".join(stay)
                    removed.append(n_lines - len(stay))
                else:
                    removed.append(0)
                sizes.append(n_lines)
                kept.append(data)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(others).columns, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=[*others, "n_lines", "n_removed", "kept"],
            )

    done = texts.mapInArrow(run, schema)
    more = [F.col(f"_extra.`{c}`") for c in extra or []]
    return done.select(F.col("_id").alias(id_col), "n_lines", "n_removed", "kept", *more)
