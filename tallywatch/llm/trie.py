"""Conversation prefix trie with subtree sums by the Euler-tour technique.

A node is a distinct sequence of first turns. Its key is a sum of turn digests times
powers of a fixed base modulo the prime 2^127 - 1, so prefixes have keys without a walk
from their start: rows are numbered and summed in range partitions, and only the totals
of conversations that cross a partition border (at most one for each border) are chained.
Two different prefixes share a key with a chance of about 2^-127 for each turn.

Every node gives an enter and an exit arc. The tour goes from a node's enter arc to the
enter arc of its first child (by smallest member) or to its own exit arc, and from there to
the next sibling's enter arc or the parent's exit arc. ``tour.sums_before`` ranks that
list; leaves and savings of a subtree are the difference of the sums before its exit and
before its enter arc.

Defined results: a null ``conv_id`` names no conversation and its rows are left out; null
role or text is empty; equal turns are ordered by role and text (by the first 64
characters, then by digest); repeated rows are turns of their own; an empty table gives an
empty result, without a root. Texts of any length are taken whole. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.tour import sums_before
from tallywatch.session import written

PRIME = 2**127 - 1
BASE = 0x5A3C96E1B7D20F48C1739E5DA8046BF3
ROOT = bytes(16)
#: Turns that a conversation can take over from another: remainders of ``FOLDS``.
FOLDS, FAMILY = 9, 5
#: Ids joined into one text before they are hashed.
IDS = 100_000


def key_of(value: int) -> bytes:
    return value.to_bytes(16, "big")


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id, nth, before, after, bytes`` of each turn: its number and the keys of the prefixes around it."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("nth", pa.int64()), ("before", pa.binary()), ("after", pa.binary()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, nth, total, power = None, 0, 0, 1
        for batch in batches:
            out = []
            for key, said, size, part in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "said", "bytes", "part")), strict=True):
                if key != conv:
                    conv, nth, total, power = key, 0, 0, 1
                nth, before, power = nth + 1, total, power * BASE % PRIME
                total = (total + int.from_bytes(said, "big") * power) % PRIME
                out.append((key, part, nth, key_of(before), key_of(total), size))
            yield batch_of(out, schema)

    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    slim = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.left(role, F.lit(64)).alias("role_key"), F.left(text, F.lit(64)).alias("text_key"), said.alias("said"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("copy"),
    ).filter("conv_id is not null")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role_key"), F.col("text_key"), F.col("said"), F.col("copy")]
    ordered = slim.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    local = written(ordered.select("conv_id", "said", "bytes", "part").mapInArrow(run, "conv_id long, part int, nth long, before binary, after binary, bytes long"), "trie-local")
    return continued(local)


def continued(local: DataFrame) -> DataFrame:
    """Numbers and keys of the conversations that go on over a partition border, from what came before the border."""
    ends = local.groupBy("conv_id", "part").agg(F.max(F.struct("nth", "after")).alias("end"))
    parts = ends.groupBy("conv_id").agg(F.count("*").alias("parts"), F.collect_list(F.struct("part", "end")).alias("ends"))
    # At most one conversation for each border; a hundred bytes for each.
    crossing = parts.filter("parts > 1").select("conv_id", F.array_sort("ends").alias("ends")).collect()
    carried = []
    for row in crossing:
        n, total = 0, 0
        for end in row["ends"]:
            if n:
                carried.append((row["conv_id"], end["part"], n, key_of(total)))
            total = (total + pow(BASE, n, PRIME) * int.from_bytes(end["end"]["after"], "big")) % PRIME
            n += end["end"]["nth"]
    carry = local.sparkSession.createDataFrame(carried, "conv_id long, part int, n long, total binary")
    schema = pa.schema([("conv_id", pa.int64()), ("nth", pa.int64()), ("before", pa.binary()), ("after", pa.binary()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, nth, before, after, size, n, total in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "nth", "before", "after", "bytes", "n", "total")), strict=True):
                shift, start = pow(BASE, n, PRIME), int.from_bytes(total, "big")
                moved = [key_of((start + shift * int.from_bytes(k, "big")) % PRIME) for k in (before, after)]
                out.append((conv, nth + n, *moved, size))
            yield batch_of(out, schema)

    both = local.join(F.broadcast(carry), ["conv_id", "part"], "left")
    settled = both.filter("n is null").select("conv_id", "nth", "before", "after", "bytes")
    moved = both.filter("n is not null").drop("part").mapInArrow(run, "conv_id long, nth long, before binary, after binary, bytes long")
    return written(settled.unionByName(moved), "trie-turns")


MEMBER_DDL = "conv_id long, depth long, node binary, parent binary, bytes long, ends boolean"


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, node, parent, bytes, ends`` of every prefix of every rebuilt conversation, the root included."""
    heads = turns.filter(F.col("nth") < FOLDS).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("nth", "before", "after", "bytes"))).alias("heads"))
    sizes = turns.groupBy("conv_id").agg(F.max("nth").alias("size"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(FOLDS))
    convs = sizes.join(heads, "conv_id").select("conv_id", "size", taken.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), F.col("heads").alias("own"))
    convs = convs.join(heads.select(F.col("conv_id").alias("base"), "heads"), "base", "left")
    convs = convs.withColumn("first", F.slice(F.coalesce("heads", F.expr("slice(own, 1, 0)")), F.lit(1), F.col("h")))
    skipped = F.when(F.col("h") == 0, F.lit(ROOT)).otherwise(F.try_element_at("own", F.greatest("h", F.lit(1)))["after"])
    joint = F.when(F.size("first") == 0, F.lit(ROOT)).otherwise(F.try_element_at("first", F.greatest(F.size("first"), F.lit(1)))["after"])
    convs = written(convs.select("conv_id", "size", "h", "first", F.size("first").alias("b"), skipped.alias("skipped"), joint.alias("joint")), "trie-convs")

    short = F.col("size") <= F.col("h")
    none = F.lit(None).cast("binary")
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"), none.alias("parent"), F.lit(0).cast("long").alias("bytes"), (short & (F.col("b") == 0)).alias("ends"))
    shared = convs.select("conv_id", "b", short.alias("short"), F.explode("first").alias("t")).select(
        "conv_id", F.col("t.nth").alias("depth"), F.col("t.after").alias("node"), F.col("t.before").alias("parent"), F.col("t.bytes").alias("bytes"),
        (F.col("short") & (F.col("t.nth") == F.col("b"))).alias("ends"),
    )
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("bytes", pa.int64()), ("ends", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = {d: pow(BASE, d, PRIME) for d in range(1 - FOLDS, 1)}
        for batch in batches:
            out = []
            for conv, nth, before, after, size, n, h, b, skipped, joint in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                start, gone, shift = int.from_bytes(joint, "big"), int.from_bytes(skipped, "big"), shifts[b - h]
                parent, node = (key_of((start + (int.from_bytes(k, "big") - gone) * shift) % PRIME) for k in (before, after))
                out.append((conv, nth - h + b, node, parent, size, nth == n))
            yield batch_of(out, schema)

    later = turns.join(convs.select("conv_id", "size", "h", "b", "skipped", "joint"), "conv_id").filter("nth > h")
    own = later.select("conv_id", "nth", "before", "after", "bytes", "size", "h", "b", "skipped", "joint").mapInArrow(run, MEMBER_DDL)
    return written(roots.unionByName(shared).unionByName(own), "trie-members")


def ends_of(members: DataFrame) -> DataFrame:
    """``node, ends_sha256``: digest of the ids that end at a node, in their order.

    Ids are joined to texts of ``IDS`` inside range partitions; only nodes at a partition's border or with
    more ids need several texts, which pass through one task as a stream, as SHA-256 asks.
    """
    schema = pa.schema([("node", pa.binary()), ("alone", pa.bool_()), ("part", pa.int32()), ("nth", pa.int32()), ("said", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held, nth, starts_here, seen, part, out = None, [], 0, False, False, 0, []
        for batch in batches:
            for key, conv, part in zip(*(batch.column(c).to_pylist() for c in ("node", "conv_id", "part")), strict=True):
                if key != node or len(held) >= IDS:
                    if seen:
                        out.append((node, key != node and starts_here, part, nth, ",".join(map(str, held))))
                    starts_here = seen and key != node
                    nth = 0 if key != node else nth + 1
                    node, held, seen = key, [], True
                held.append(conv)
            yield batch_of(out, schema)
            out = []
        if seen:
            yield batch_of([(node, False, part, nth, ",".join(map(str, held)))], schema)

    found = members.filter("ends").select("node", "conv_id")
    ordered = found.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").withColumn("part", F.spark_partition_id())
    pieces = written(ordered.mapInArrow(run, "node binary, alone boolean, part int, nth int, said string"), "trie-ends")
    digest = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for key, said in zip(batch.column("node").to_pylist(), batch.column("said").to_pylist(), strict=True):
                if key != node:
                    if node is not None:
                        out.append((node, state.hexdigest()))
                    node, state = key, hashlib.sha256(said.encode())
                else:
                    state.update(b"," + said.encode())
            yield batch_of(out, digest)
            out = []
        if node is not None:
            yield batch_of([(node, state.hexdigest())], digest)

    several = pieces.filter("not alone").repartition("node").sortWithinPartitions("node", "part", "nth").select("node", "said")
    whole = pieces.filter("alone").select("node", F.sha2("said", 256).alias("ends_sha256"))
    return whole.unionByName(several.mapInArrow(stream, "node binary, ends_sha256 string"))


def next_siblings(nodes: DataFrame) -> DataFrame:
    """``node, sibling``: the child of the same parent with the next smallest member, where there is one."""
    schema = pa.schema([("node", pa.binary()), ("sibling", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("part", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for node, parent, conv, part in zip(*(batch.column(c).to_pylist() for c in ("node", "parent", "conv_id", "part")), strict=True):
                if held is not None:
                    out.append((held[0], node if held[1] == parent else None, *held[1:]))
                held = (node, parent, conv, part)
            yield batch_of(out, schema)
        if held is not None:
            yield batch_of([(held[0], None, *held[1:])], schema)

    below = nodes.filter("parent is not null").select("node", "parent", "conv_id")
    ordered = below.repartitionByRange("parent", "conv_id").sortWithinPartitions("parent", "conv_id").withColumn("part", F.spark_partition_id())
    linked = written(ordered.mapInArrow(run, "node binary, sibling binary, parent binary, conv_id long, part int"), "trie-siblings")
    row = F.struct("parent", "conv_id", "node")
    # One row for each partition.
    borders = linked.groupBy("part").agg(F.min(row).alias("low"), F.max(row).alias("high")).orderBy("part").collect()
    over = [(a["high"]["node"], b["low"]["node"]) for a, b in zip(borders, borders[1:]) if a["high"]["parent"] == b["low"]["parent"]]
    across = nodes.sparkSession.createDataFrame(over, "node binary, over binary")
    return linked.join(F.broadcast(across), "node", "left").select("node", F.coalesce("sibling", "over").alias("sibling"))


def arcs(nodes: DataFrame) -> DataFrame:
    """Enter and exit arcs in the form of ``tour.sums_before``; weights are leaves and savings."""
    enter = lambda c: F.concat(F.col(c), F.lit(b"\x00"))
    leave = lambda c: F.concat(F.col(c), F.lit(b"\x01"))
    weights = F.array(F.col("first").isNull().cast("long"), "saved")
    zeros = F.array(F.lit(0).cast("long"), F.lit(0).cast("long"))
    into = F.struct(enter("node").alias("id"), F.coalesce(enter("first"), leave("node")).alias("next"), weights.alias("sums"))
    out = F.struct(leave("node").alias("id"), F.coalesce(enter("sibling"), leave("parent")).alias("next"), zeros.alias("sums"))
    both = nodes.select(F.col("conv_id").alias("place"), F.col("depth").alias("spot"), F.explode(F.array(into, out)).alias("arc"))
    return written(both.select("arc.id", "arc.next", "arc.sums", "place", "spot"), "trie-arcs")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``node, parent`` (keys) and the contract's columns."""
    members = rebuilt(numbered(conversations))
    plain = members.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes")
    )
    nodes = written(plain.withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), "trie-nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"), F.min(F.struct("conv_id", "node"))["node"].alias("first"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    tree = nodes.join(children, "node", "left").join(next_siblings(nodes), "node", "left").join(above, "parent", "left")
    tree = written(tree, "trie-tree")

    before = sums_before(arcs(tree)).select(F.substring("id", 1, 16).alias("node"), F.substring("id", 17, 1).alias("way"), "before")
    spans = before.groupBy("node").agg(F.max(F.when(F.col("way") == F.lit(b"\x00"), F.col("before"))).alias("low"), F.max(F.when(F.col("way") == F.lit(b"\x01"), F.col("before"))).alias("high"))
    found = tree.join(spans, "node").join(ends_of(members), "node", "left")
    return found.select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        (F.col("high")[0] - F.col("low")[0]).alias("n_leaves"), (F.col("high")[1] - F.col("low")[1]).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
