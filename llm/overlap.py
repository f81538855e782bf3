"""N-gram Jaccard join: T-occurrence search with DivideSkip over shingle sets, and the classes that its links form.

Texts with equal sets are one node. Each node gives its least frequent shingles, just so many that two sets that link
share at least one (frequent ones, found by counting all documents, come last). What shares such a key is a candidate:

* first, each node is searched for by one node that shares most keys with it; the links found form provisional classes;
* where many classes still have one key, each is searched for in a block of the class that has most members there. As
  long as a round joins a tenth of those that ask, another one follows, so that a group of near copies becomes a class
  before pairs are formed. A round reads each member once or twice, and only finds links early: what it leaves, the
  last search compares;
* then classes (not their members) that share enough keys become pairs, and the members of the smaller are searched
  for among those of the larger. Members of one class need no further link, so groups of copies give no pairs.

A search takes a block of indexed sets and turns them into inverted lists. For each query the longest lists are set
aside, the short ones are merged with counts, and only sets that can still reach the required overlap T are probed for
in the long ones by bisection. Every count is complete, so the Jaccard test that follows is exact.

Null and empty texts have empty sets, link with nothing and are their own class. Texts shorter than a shingle are one
shingle. Very long texts count whole. Rows with equal sets share a class; rows without id link as others do, and a
class of only such rows has a null id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, discard, prefix_hash, span_hash, stored, text_buffer, word_hashes
from .components import components

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SKETCH_BITS = 20
#: Longest table of frequent shingle buckets that is broadcast.
FREQUENT = 1 << 16
BLOCK_SETS = 512
SHARD_SETS = 2000
#: Classes with one key beyond which they are joined in rounds before pairs of them are formed.
CROWD = 8


def text_sets(buf: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's ``n``-word shingles; a shorter text is one shingle."""
    hashes, first, _, _ = word_hashes(_LOWER[buf], at)
    sums = prefix_hash(hashes)
    out = []
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        start = np.arange(lo, max(lo + 1, hi - n + 1)) if hi > lo else np.zeros(0, np.int64)
        out.append(np.unique(span_hash(sums, start, np.minimum(start + n, hi))))
    return out


def _batch_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    buf, at = text_buffer(column)
    for lo, hi in blocks(at):
        yield from text_sets(buf[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], n)


def frequent_buckets(texts: DataFrame, n: int) -> dict[int, int]:
    """Counts of the buckets of shingles that are far more frequent than the mean in some part of the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for s in _batch_sets(batch.column(0), n):
                np.add.at(seen, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        heavy = np.flatnonzero(seen > 4 * seen.mean() + 3)
        yield pa.RecordBatch.from_arrays([pa.array(heavy), pa.array(seen[heavy])], names=["bucket", "n"])

    counts = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    # the order of shingles need only be the same everywhere, so a bounded table does
    return {r["bucket"]: r["n"] for r in counts.orderBy(F.desc("n"), "bucket").limit(FREQUENT).toArrow().to_pylist()}


def _ceil(n: Column | int, percent: int) -> Column | int:
    """``percent`` of ``n``, rounded up."""
    return -((-n * percent) // 100) if isinstance(n, int) else F.ceil(n * percent / 100)


def keyed_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``id``, ``text_hash``, ``size``, ``node`` (a hash of the set) and ``keys`` (its least frequent shingles)."""
    frequent = frequent_buckets(docs.select("text"), n)
    table = np.zeros(1 << SKETCH_BITS, np.int32)
    for bucket, count in frequent.items():
        table[bucket] = min(count, 2**31 - 1)
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, keys = [], [], []
            for s in _batch_sets(batch.column(2), n):
                order = np.argsort(sent.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
                sizes.append(len(s))
                sums = prefix_hash(s)
                nodes.append(int(span_hash(sums, np.array([0]), np.array([len(s)])).view(np.int64)[0]))
                keys.append(s[order[: len(s) - _ceil(len(s), percent) + 1]].view(np.int64) if len(s) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "text_hash", "size", "node", "keys"],
            )

    id_type = dict(docs.dtypes)["id"]
    return docs.mapInArrow(run, f"id {id_type}, text_hash long, size int, node long, keys array<long>")


def divide_skip(lists: list[np.ndarray], needed: int) -> tuple[np.ndarray, np.ndarray]:
    """The members of at least ``needed`` of the sorted ``lists``, and how many lists hold each."""
    lists = sorted((x for x in lists if len(x)), key=len)
    if len(lists) < needed:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    longest = len(lists[-1])
    aside = min(needed - 1, int(needed / (0.01 * np.log2(longest + 1) + 1)), len(lists))
    short, long_ = lists[: len(lists) - aside], lists[len(lists) - aside :]
    if sum(map(len, short)) < 64:
        merged, count = [], []
        for x in heapq.merge(*(s.tolist() for s in short)):
            if merged and merged[-1] == x:
                count[-1] += 1
            else:
                merged.append(x)
                count.append(1)
        members, seen = np.array(merged, np.int64), np.array(count, np.int64)
    else:
        members, seen = np.unique(np.concatenate(short), return_counts=True)
    kept = seen >= needed - aside
    members, seen = members[kept], seen[kept]
    for i, x in enumerate(long_):
        if not len(members):
            break
        at = np.searchsorted(x, members)
        seen += x[np.minimum(at, len(x) - 1)] == members
        kept = seen >= needed - (len(long_) - 1 - i)
        members, seen = members[kept], seen[kept]
    return members, seen


def linked(indexed: list[np.ndarray], queries: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Places (query, indexed) of all pairs of sets with Jaccard similarity of at least ``percent`` in a hundred."""
    sizes = np.array([len(s) for s in indexed], np.int64)
    if not len(indexed) or not sizes.sum():
        return
    owner = np.repeat(np.arange(len(indexed)), sizes)
    every = np.concatenate(indexed)
    order = np.lexsort((owner, every))
    every, owner = every[order], owner[order]
    for i, q in enumerate(queries):
        if not len(q):
            continue
        lo, hi = np.searchsorted(every, q, "left"), np.searchsorted(every, q, "right")
        members, shared = divide_skip([owner[a:b] for a, b in zip(lo, hi, strict=True) if b > a], _ceil(len(q), percent))
        good = 100 * shared >= percent * (len(q) + sizes[members] - shared)
        for m in members[good]:
            yield i, int(m)


def _search(texts: DataFrame, members: DataFrame, queries: DataFrame, n: int, percent: int) -> DataFrame:
    """Links ``a``, ``b`` found by searching the ``queries`` (``part``, ``node``) of each part among its ``members``."""
    marked = members.select("part", "node", F.lit(False).alias("asks")).unionByName(queries.select("part", "node", F.lit(True).alias("asks")))
    return _links(marked.join(texts, "node"), n, percent)


def _links(sent: DataFrame, n: int, percent: int) -> DataFrame:
    """Links ``a``, ``b`` of the texts (``part``, ``node``, ``asks``, ``packed``) that ask to those of their part that do not."""

    def run(part: pa.Table) -> pa.Table:
        unpress = zstandard.ZstdDecompressor()
        found: tuple[list[int], list[int]] = ([], [])
        if len(part):
            nodes, asks = part["node"].to_numpy(), part["asks"].to_numpy()
            sets = list(_batch_sets(pa.array([unpress.decompress(p) for p in part["packed"].to_pylist()], pa.large_binary()), n))
            here, there = np.flatnonzero(~asks), np.flatnonzero(asks)
            for i, m in linked([sets[x] for x in here], [sets[x] for x in there], percent):
                if nodes[there[i]] != nodes[here[m]]:
                    found[0].append(int(nodes[there[i]]))
                    found[1].append(int(nodes[here[m]]))
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return sent.select("part", "node", "asks", "packed").groupBy("part").applyInArrow(run, "a long, b long")


def _parts(pairs: DataFrame, total: int) -> DataFrame:
    """``group``, ``node`` members dealt into blocks, many small groups sharing a shard: adds ``block`` and ``part``."""
    shards = max(1, total // SHARD_SETS)
    return pairs.withColumn("part", F.pmod(F.xxhash64("group", F.col("block").cast("long")), F.lit(shards)))


def _dealt(pairs: DataFrame, member: DataFrame, extent: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``part``, ``node`` of the members of each ``group`` and of the members of the ``other`` classes that ask there.

    Both sides are dealt into blocks, and each block of one meets each of the other in a part of its own. Groups of one
    block on either side share shards.
    """
    asks = pairs.join(extent.select(F.col("c").alias("other"), F.col("members").alias("_m")), "other").groupBy("group").agg(F.sum("_m").alias("asks"))
    sizes = asks.join(extent.select(F.col("c").alias("group"), "members"), "group")
    plan = stored(sizes.select("group", *[F.ceil(F.col(c) / BLOCK_SETS).cast("int").alias(to) for c, to in (("members", "blocks"), ("asks", "turns"))], (F.col("members") + F.col("asks")).alias("n")))
    small = F.expr("blocks = 1 AND turns = 1")
    shards = max(1, (plan.where(small).agg(F.sum("n")).first()[0] or 0) // SHARD_SETS)
    part = F.when(small, F.pmod(F.xxhash64("group"), F.lit(shards))).otherwise(F.xxhash64("group", "block", "turn")).alias("part")
    own = {c: F.pmod(F.xxhash64("node"), F.col(f"{c}s")) for c in ("block", "turn")}
    each = {c: F.explode(F.sequence(F.lit(0), F.col(f"{c}s") - 1)) for c in ("block", "turn")}
    inside = member.withColumnRenamed("c", "group").join(plan, "group").withColumn("block", own["block"].cast("int")).withColumn("turn", each["turn"])
    asking = pairs.join(plan, "group").join(member.withColumnRenamed("c", "other"), "other").withColumn("turn", own["turn"].cast("int")).withColumn("block", each["block"])
    return inside.select(part, "node").distinct(), asking.select(part, "node").distinct()


def _near(percent: int, a: str, b: str) -> Column:
    """Whether some sets of ``lo`` to ``hi`` shingles of the columns ``a`` and ``b`` can link by their sizes."""
    return (F.col(f"hi{a}") * 100 >= percent * F.col(f"lo{b}")) & (F.col(f"hi{b}") * 100 >= percent * F.col(f"lo{a}"))


def _labelled(keys: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``keys`` with the class ``c`` of each node; and of each key the classes that have it, with their nodes ``n`` and sizes there."""
    label = keys.select("key", "node", "size").join(classes, "node", "left").withColumn("c", F.coalesce("component", "node"))
    return label, stored(label.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("lo"), F.max("size").alias("hi")))


def join_crowds(keys: DataFrame, texts: DataFrame, classes: DataFrame, total: int, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``classes`` after the rounds in which classes crowding around a key are joined, and what ``_labelled`` says of them."""
    turn = 0
    while True:
        label, held = _labelled(keys, classes)
        hub = held.groupBy("key").agg(F.count(F.lit(1)).alias("_m"), F.max(F.struct("n", "c", "lo", "hi")).alias("h")).where(F.col("_m") > CROWD)
        hub = hub.select("key", F.col("h.c").alias("group"), F.col("h.lo").alias("lo2"), F.col("h.hi").alias("hi2"))
        asks = held.select("key", "c", F.col("lo").alias("lo1"), F.col("hi").alias("hi1")).join(hub, "key").where((F.col("c") != F.col("group")) & _near(percent, "1", "2"))
        best = asks.groupBy("c", "group").count().groupBy("c").agg(F.max(F.struct("count", "group")).alias("m"))
        best = stored(best.select("c", "m.group"))
        asking = best.count()
        if not asking:
            discard(best)
            return classes, label, held
        # a class of many blocks is asked in one of them by each node, in another one in the next round
        member = label.select("c", "node").distinct()
        queries = best.join(member, "c").select("group", "node")
        inside = best.select("group").distinct().join(member.withColumnRenamed("c", "group"), "group").select("group", "node")
        both = stored(inside.withColumn("asks", F.lit(0)).unionByName(queries.withColumn("asks", F.lit(1))))
        sizes = both.groupBy("group").agg(F.greatest(F.sum("asks"), F.sum(1 - F.col("asks"))).alias("_n"))
        dealt = both.join(sizes.select("group", F.ceil(F.col("_n") / BLOCK_SETS).alias("_blocks")), "group")
        dealt = _parts(dealt.withColumn("block", F.pmod(F.xxhash64("node", F.lit(turn)), "_blocks")), total).select("part", "node", "asks")
        more = _search(texts, *(dealt.where(F.col("asks") == x).select("part", "node").distinct() for x in (0, 1)), n, percent)
        before, classes = classes, stored(components(_stars(classes).unionByName(more)))
        moved = _joined(classes) - _joined(before)
        discard(held, best, both, before)
        if 10 * moved < asking:
            return classes, *_labelled(keys, classes)
        turn += 1


def _stars(classes: DataFrame) -> DataFrame:
    return classes.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _joined(classes: DataFrame) -> int:
    """How many classes fewer there are than nodes."""
    return classes.agg(F.count(F.lit(1)) - F.countDistinct("component")).first()[0]


def similar_classes(documents: DataFrame, *, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row ``id_col``, ``n_shingles``, ``component_id`` (the smallest id reachable by links), ``text_hash`` and ``first``.

    ``first`` is true for one row of each class (the smallest id, with the smallest text hash; without ids, the latter).
    Only rows equal in id and text are all true together; so are all rows with an empty set.
    """
    docs = documents.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), F.col(text_col).alias("text"))
    keyed = stored(keyed_sets(docs, n, percent))
    rows = stored(keyed.drop("keys"))
    nodes = keyed.where("size > 0").groupBy("node").agg(F.min(F.struct("size", "keys")).alias("r"))
    keys = stored(_shared_keys(nodes.select("node", "r.size", F.explode("r.keys").alias("key"))))
    discard(keyed)
    wanted = keys.select("node").distinct().join(rows.groupBy("node").agg(F.min("text_hash").alias("text_hash")), "node")
    total = wanted.count()

    # first search: each node by the node that shares most keys with it; the texts are stored with the parts they go to
    ask = keys.where(F.expr(f"node <> least AND 100 * size >= {percent} * least_size AND 100 * least_size >= {percent} * size"))
    votes = ask.groupBy("node", "least").count()
    best = votes.groupBy("node").agg(F.max(F.struct("count", F.col("least").alias("group"))).alias("m")).select("node", "m.group")
    first = _parts(best.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(1 + total // BLOCK_SETS))), total)
    sides = first.select("part", "node", F.lit(False).alias("asks")).unionByName(first.select("part", F.col("group").alias("node"), F.lit(True).alias("asks")).distinct())
    goes = sides.groupBy("node").agg(F.collect_list(F.struct("part", "asks")).alias("parts"))
    texts = stored(_texts(docs, wanted.join(goes, "node", "left")))
    links = stored(_links(texts.select("node", "packed", F.explode("parts").alias("_p")).select("_p.*", "node", "packed"), n, percent).distinct())
    classes = stored(components(links))

    # second search: classes that share enough keys, members of the smaller among those of the larger
    classes, label, found = join_crowds(keys, texts, classes, total, n, percent)
    many = found.groupBy("key").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1").select("key")
    held = found.join(many, "key")
    left = held.select("key", *[F.col(x).alias(f"{x}1") for x in ("c", "lo", "hi")])
    right = held.select("key", *[F.col(x).alias(f"{x}2") for x in ("c", "lo", "hi")])
    shared = left.join(right, "key").where((F.col("c1") < F.col("c2")) & _near(percent, "1", "2")).groupBy("c1", "c2").agg(
        F.count(F.lit(1)).alias("shared"), *[F.min(f"lo{i}").alias(f"lo{i}") for i in "12"], *[F.max(f"hi{i}").alias(f"hi{i}") for i in "12"]
    )
    # Sets of x <= y shingles that link share T >= (x + y) percent / (100 + percent). Of these, fewer than percent of y
    # lie outside the common keys: all common shingles up to the end of the shorter-reaching keys are keys of both.
    x, y = F.least("lo1", "lo2"), F.greatest("hi1", "hi2")
    least_shared = (x + y) * percent / (100 + percent) - y * percent / 100
    shared = shared.where(F.col("shared") > least_shared - 1e-9).select("c1", "c2")
    extent = label.groupBy("c").agg(F.countDistinct("node").alias("members"))
    for i in "12":
        shared = shared.join(extent.select(F.col("c").alias(f"c{i}"), F.col("members").alias(f"members{i}")), f"c{i}")
    pairs = stored(shared.select(
        F.when(F.col("members1") > F.col("members2"), F.col("c1")).otherwise(F.col("c2")).alias("group"),
        F.when(F.col("members1") > F.col("members2"), F.col("c2")).otherwise(F.col("c1")).alias("other"),
    ))
    discard(found)
    inside, asking = _dealt(pairs, label.select("c", "node").distinct(), extent)
    more = _search(texts, inside, asking, n, percent)
    before, classes = classes, components(_stars(classes).unionByName(more))
    discard(keys, texts, links, before, pairs)

    named = rows.join(classes, "node", "left").withColumn("c", F.coalesce("component", "node"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    smallest = named.where("size > 0").groupBy("c").agg(F.min("id").alias("component_id"), F.min(order).alias("least"))
    out = named.where("size > 0").join(smallest, "c")
    out = out.select("id", "size", "component_id", "text_hash", order.eqNullSafe(F.col("least")).alias("first"))
    out = out.unionByName(named.where("size = 0").select("id", "size", F.col("id").alias("component_id"), "text_hash", F.lit(True).alias("first")))
    return out.select(F.col("id").alias(id_col), F.col("size").cast("long").alias("n_shingles"), "component_id", "text_hash", "first")


def _shared_keys(postings: DataFrame) -> DataFrame:
    """The keys of more than one node: ``key``, ``node``, ``size`` and the smallest node that has it (``least``, ``least_size``).

    Most keys have one node, so the postings move once; those of a key stream through a task, which spills what is too long.
    """
    own = Window.partitionBy("key")
    seen = postings.select("key", "node", "size", F.count(F.lit(1)).over(own).alias("_n"), F.min(F.struct("node", "size")).over(own).alias("m"))
    return seen.where("_n > 1").select("key", "node", "size", F.col("m.node").alias("least"), F.col("m.size").alias("least_size"))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` (one for each ``text_hash``) with the compressed text (``packed``) instead of its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([press.compress((t.as_py() or "").encode()) for t in batch.column(1)], pa.binary())], names=["text_hash", "packed"]
            )

    packed = docs.select("text_hash", "text").mapInArrow(run, "text_hash long, packed binary").dropDuplicates(["text_hash"])
    return packed.join(wanted, "text_hash").drop("text_hash")

