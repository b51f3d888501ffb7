"""Prefix trie over conversations, built as burst tries.

A conversation is a sequence of turn ids, cut into segments of ``SEGMENT``
turns; the turns before a segment name the trie head it hangs under, so all
depths are built at once and no row holds a whole endless conversation.
Suffixes under one head lie in a container. A container with too many distinct
suffixes bursts: it becomes a head behind the turns they all share, and its
suffixes go to new containers by their next turn id. The remaining containers
are dealt over shards; there each one is sorted and swept into nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.plans.joins import checked_join
from lettermill.session import staged

SEGMENT = 256  # turns
CONTAINER_ROWS = 4_096  # distinct suffixes; a fuller container bursts
SHARD_ROWS = 16_384
GROUP = 5  # conversations c - c % GROUP ... share first turns
SHARED = 9
PIECE_BYTES = 1 << 16

_NODE = "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, size long, row_key string"
_SWEPT = f"{_NODE}, container string, above array<string>"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, id, size)``; a turn's id is the hash of its role and text, null as empty."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("id"), F.octet_length(text).cast("long").alias("size"),
    )


def with_positions(turns: DataFrame) -> DataFrame:
    """``(conv_id, p, id, size)``: place of every turn in its conversation, from 0.

    Turns are sorted over the cluster by conversation and turn, so that a
    conversation of any length spreads over many tasks; each numbers its own
    part, and the lengths of the parts before are added.
    """
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("id")]
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "id", "size")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, upto = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column("conv_id").to_numpy()
            if not len(conv):
                continue
            heads = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
            size = np.diff(np.append(heads, len(conv)))
            at = np.arange(len(conv)) - np.repeat(heads, size)
            if conv[0] == last:
                at[: size[0]] += upto
            last, upto = conv[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(np.full(len(conv), part)), pa.array(at), batch.column("id"), batch.column("size")],
                ["conv_id", "part", "at", "id", "size"],
            )

    numbered = staged(ordered.mapInArrow(number, "conv_id long, part long, at long, id long, size long"), "numbered-turns")
    parts = numbered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifted = staged(parts.withColumn("before", before).filter("before is not null").drop("n"), "shifted-parts")
    placed = checked_join(numbered, shifted, ["conv_id", "part"])  # at most one row a task
    return placed.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("p"), "id", "size")


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids of all conversations ``(conv_id)``, and the turns ``(conv_id, d, id, size)`` of the rebuilt ones, d from 0.

    The first h turns come from conversation c - c % 5, the others are c's own
    after its first h; h is the CRC-32 of the decimal id modulo 9.
    """
    turns = staged(with_positions(turn_rows(conversations)), "placed-turns")
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    own = staged(own.select("conv_id", "n", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base")), "conversations")
    lengths = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = own.join(lengths, "base", "left").select(
        "conv_id", "h", "base", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")
    )
    heads = turns.filter((F.col("p") < SHARED - 1) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed("conv_id", "base")
    copied = convs.join(heads, "base").filter("p < h").select("conv_id", F.col("p").alias("d"), "id", "size")
    later = checked_join(turns, convs, "conv_id", "inner").filter("p >= h").select("conv_id", (F.col("p") - F.col("h") + F.col("taken")).alias("d"), "id", "size")
    return own.select("conv_id"), copied.unionByName(later)


def segment_rows(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Segments ``(conv_id, seg, head, next_head, row_key, turns, sizes, last)`` of every conversation, one at least.

    ``head`` names the turns before the segment, ``next_head`` those up to its
    end, both as 128 bits from the segments and their numbers; ``row_key`` the
    segment under its head. A conversation without turns has an empty segment.
    """
    none = F.array().cast("array<long>")
    cut = (
        turns.groupBy("conv_id", F.expr(f"d div {SEGMENT}").alias("seg"))
        .agg(F.sort_array(F.collect_list(F.struct("d", "id", "size"))).alias("x"))  # SEGMENT at most
        .select("conv_id", "seg", F.col("x.id").alias("turns"), F.col("x.size").alias("sizes"))
    )
    bare = convs.join(cut.select("conv_id").distinct(), "conv_id", "left_anti")
    cut = cut.unionByName(bare.select("conv_id", F.lit(0).cast("long").alias("seg"), none.alias("turns"), none.alias("sizes")))
    marks = [F.xxhash64(F.lit(k), "seg", "turns") for k in (0, 1)]
    cut = cut.withColumns({"m0": marks[0], "m1": marks[1]})
    conv = Window.partitionBy("conv_id").orderBy("seg")
    before = conv.rowsBetween(Window.unboundedPreceding, -1)
    xor = lambda c, w: F.coalesce(F.bit_xor(c).over(w), F.lit(0).cast("long"))
    name = lambda *c: F.concat_ws(":", *[F.hex(x) for x in c])
    return staged(
        cut.withColumns({
            "b0": xor("m0", before), "b1": xor("m1", before), "last": F.lead("seg").over(conv).isNull(),
        }).select(
            "conv_id", "seg", name(F.col("b0"), F.col("b1")).alias("head"),
            name(F.col("b0").bitwiseXOR(F.col("m0")), F.col("b1").bitwiseXOR(F.col("m1"))).alias("next_head"),
            F.concat_ws("/", "seg", name(F.col("b0"), F.col("b1"), F.col("m0"), F.col("m1"))).alias("row_key"),
            "turns", "sizes", "last",
        ),
        "segments",
    )


def distinct_rows(segments: DataFrame) -> DataFrame:
    """One row per different segment under a head, with its conversations counted; copies end here."""
    return staged(
        segments.groupBy("seg", "head", "row_key").agg(
            F.first("next_head").alias("next_head"), F.first("turns").alias("turns"), F.first("sizes").alias("sizes"),
            F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first_id"),
        ),
        "distinct-segments",
    )


def head_children(rows: DataFrame) -> DataFrame:
    """``(seg, head, children)``: how many different turns follow a head."""
    firsts = rows.filter(F.size("turns") > 0).select("seg", "head", F.col("turns")[0].alias("turn")).distinct()
    return firsts.groupBy("seg", "head").agg(F.count(F.lit(1)).alias("children"))


def _first_differing(low: Column, high: Column) -> Column:
    """Number of leading elements that two arrays share."""
    same = F.zip_with(low, high, lambda a, b: F.coalesce(a == b, F.lit(False)))
    at = F.array_position(same, F.lit(False))
    return F.when(at > 0, at - 1).otherwise(F.size(same)).cast("int")


def burst(suffixes: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Containers of at most ``limit`` distinct suffixes, and the heads that fuller ones became.

    The least and the greatest suffix of a container share what all of them
    share, so one step goes past it; each step is one grouped count. Rows that
    end at a head leave as part of it.
    """
    open_rows, heads = staged(suffixes, "suffixes"), []
    while True:
        sizes = open_rows.groupBy("container").agg(
            F.count(F.lit(1)).alias("rows"), F.min("turns").alias("low"), F.max("turns").alias("high"),
            F.sum("n").alias("n_convs"), F.min("first_id").alias("conv_id"),
        )
        big = staged(sizes.filter(F.col("rows") > limit).withColumn("shared", _first_differing(F.col("low"), F.col("high"))), "full-containers")
        if big.isEmpty():
            return open_rows, reduce(DataFrame.unionByName, heads) if heads else None
        marked = checked_join(open_rows, big.select("container", "shared", "n_convs", "conv_id"), "container")
        full = marked.filter("shared is not null")
        heads.append(staged(_new_heads(full), "heads"))
        rest = F.expr("slice(turns, shared + 1, greatest(size(turns) - shared, 1))")
        rest_sizes = F.expr("slice(sizes, shared + 1, greatest(size(sizes) - shared, 1))")
        dealt = full.filter("size(turns) > shared").select(
            F.md5(F.concat_ws("/", "container", rest[0].cast("string")).cast("binary")).alias("container"), "seg",
            (F.col("at") + F.col("shared")).alias("at"), F.when(F.col("shared") > 0, F.col("conv_id")).otherwise(F.col("top_id")).alias("top_id"),
            F.array_append("above", F.col("container")).alias("above"), "row_key", rest.alias("turns"), rest_sizes.alias("sizes"),
            "n", "first_id", "more", "leaves", "saved",
        )
        open_rows = staged(marked.filter("shared is null").select(*open_rows.columns).unionByName(dealt), "suffixes")


def _new_heads(full: DataFrame) -> DataFrame:
    """One row a burst container: the shared turns' sizes, its conversations, what follows, and the row that ends there."""
    turn = F.when(F.size("turns") > F.col("shared"), F.expr("try_element_at(turns, shared + 1)"))
    by_turn = full.groupBy("container", turn.alias("turn")).agg(
        *[F.first(c).alias(c) for c in ("seg", "at", "top_id", "above", "shared", "n_convs", "conv_id")],
        F.first(F.expr("slice(sizes, 1, shared)")).alias("sizes"), F.max(F.when(F.size("turns") == F.col("shared"), F.col("row_key"))).alias("row_key"),
    )
    return by_turn.groupBy("container").agg(
        *[F.first(c).alias(c) for c in ("seg", "at", "top_id", "above", "shared", "n_convs", "conv_id", "sizes")],
        F.count("turn").alias("n_children"), F.max("row_key").alias("row_key"),
    )


def sweep(rows: list[tuple], at: int, top_id: int) -> Iterator[list]:
    """Nodes below the top of one container, from its suffixes ``(turns, sizes, n, first_id, more, leaves, saved, row_key)`` in order.

    The open path is a stack. A suffix closes the nodes it does not share with
    the one before; a closed node passes what it gathered to its parent.
    """
    path: list[list] = []  # [depth, conv_id, parent, n_convs, children, leaves, saved, size, row_key] and the nodes that await its id
    waiting: list[list[list]] = [[]]

    def close() -> list:
        node, children = path.pop(), waiting.pop()
        for child in children:
            child[2] = node[1]
        if not node[4]:
            node[5] = 1
        node[6] += (node[3] - 1) * node[7]
        waiting[-1].append(node)
        if path:
            above = path[-1]
            above[1] = min(above[1], node[1])
            above[3] += node[3]
            above[4] += 1
            above[5] += node[5]
            above[6] += node[6]
        return children

    before: list[int] = []
    for turns, sizes, n, first_id, more, leaves, saved, row_key in rows:
        common = 0
        for a, b in zip(before, turns):
            if a != b:
                break
            common += 1
        while len(path) > common:
            yield from close()
        for depth in range(common, len(turns)):
            path.append([at + depth + 1, first_id, None, 0, 0, 0, 0, sizes[depth], None])
            waiting.append([])
        node = path[-1]
        node[1] = min(node[1], first_id)
        node[3] += n
        node[4] += more
        node[5] += leaves
        node[6] += saved
        node[8] = row_key
        before = turns
    while path:
        yield from close()
    for node in waiting[0]:
        node[2] = top_id
        yield node


def swept_nodes(suffixes: DataFrame) -> DataFrame:
    """All nodes of the containers; the nodes right below a container's top keep its name and the heads above it."""
    n_shards = max(1, -(-suffixes.count() // SHARD_ROWS))
    names = [c.split()[0] for c in _SWEPT.split(", ")]
    values = ("n", "first_id", "more", "leaves", "saved", "row_key")

    def sweep_shard(shard: pd.DataFrame) -> pd.DataFrame:
        found = []
        for container, group in shard.groupby("container", sort=False):
            rows = sorted(
                zip(*([x.tolist() for x in group[c]] for c in ("turns", "sizes")), *(group[c].tolist() for c in values)),
                key=lambda row: row[0],
            )
            seg, at, above = group["seg"].iloc[0], int(group["at"].iloc[0]), list(group["above"].iloc[0])
            for node in sweep(rows, int(seg) * SEGMENT + at, int(group["top_id"].iloc[0])):
                top = node[0] == seg * SEGMENT + at + 1
                found.append([*node, container if top else None, above if top else None])
        return pd.DataFrame(found, columns=names)

    shard = F.pmod(F.xxhash64("container"), F.lit(n_shards))
    used = suffixes.filter(F.size("turns") > 0)
    return used.groupBy(shard.alias("shard")).applyInPandas(sweep_shard, _SWEPT)


def head_nodes(heads: DataFrame, swept: DataFrame) -> DataFrame:
    """Nodes of the turns that the suffixes of a burst container share, with the sums of all containers below."""
    tops = swept.filter("container is not null").select(F.explode("above").alias("container"), "n_leaves", "saved_tokens")
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    inner = heads.select(F.explode("above").alias("container"), F.lit(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * total).alias("saved_tokens"))
    below = tops.unionByName(inner).groupBy("container").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
    rows = heads.join(below, "container").select("*", F.posexplode("sizes").alias("i", "size"))
    at_end = F.col("i") == F.col("shared") - 1
    own = F.expr("aggregate(slice(sizes, i + 1, shared - i), 0L, (a, x) -> a + x)")
    return rows.select(
        (F.col("seg") * SEGMENT + F.col("at") + F.col("i") + 1).alias("depth"), "conv_id",
        F.when(F.col("i") == 0, F.col("top_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        F.when(at_end, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * own).alias("saved_tokens"), "size", F.when(at_end, F.col("row_key")).alias("row_key"),
    )


def trie_nodes(rows: DataFrame, root_id: int, below: DataFrame | None, limit: int) -> DataFrame:
    """All nodes but the root; ``below (row_key, more, leaves, saved)`` is what follows a segment's end, if any does."""
    extra = ("more", "leaves", "saved")
    zero = F.lit(0).cast("long")
    if below is None:
        rows = rows.withColumns(dict.fromkeys(extra, zero))
    else:
        rows = checked_join(rows, below, "row_key").withColumns({c: F.coalesce(c, zero) for c in extra})
    first = rows.filter("seg = 0").withColumn("top_id", F.lit(root_id).cast("long"))
    if below is not None:
        tops = rows.select((F.col("seg") + 1).alias("seg"), F.col("next_head").alias("head"), F.col("first_id").alias("top_id"))
        first = first.unionByName(rows.filter("seg > 0").join(tops, ["seg", "head"]))
    suffixes = first.select(
        F.concat_ws("/", "seg", "head").alias("container"), "seg", F.lit(0).alias("at"), "top_id",
        F.array().cast("array<string>").alias("above"), "row_key", "turns", "sizes", "n", "first_id", *extra,
    )
    suffixes, heads = burst(suffixes, limit)
    swept = staged(swept_nodes(suffixes), "swept")
    nodes = swept.select(*[c.split()[0] for c in _NODE.split(", ")])
    return staged(nodes.unionByName(head_nodes(heads, swept)), "nodes") if heads is not None else nodes


def _below(segments: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(row_key, leaves, saved)``: leaves and saved bytes that follow a segment's end.

    A node belongs to its smallest conversation. Bytes of later segments less
    those of owned nodes, and owned leaves, are summed from the back of each
    conversation, then over the conversations of a segment; no step goes segment by segment.
    """
    owned = nodes.groupBy("conv_id", F.expr(f"(depth - 1) div {SEGMENT}").alias("seg")).agg(
        F.sum("size").alias("own"), F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf")
    )
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = segments.join(owned, ["conv_id", "seg"], "left").select(
        "conv_id", "seg", "row_key", (size - F.coalesce("own", F.lit(0))).alias("saved"), F.coalesce("leaf", F.lit(0)).alias("leaf")
    )
    behind = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.withColumns({"s": F.sum("saved").over(behind), "l": F.sum("leaf").over(behind)}).filter("s is not null")
    return sums.groupBy("row_key").agg(F.sum("l").alias("leaves"), F.sum("s").alias("saved"))


def id_digests(ends: DataFrame) -> DataFrame:
    """``(row_key, sha)``: SHA-256 of the ascending, comma-joined ids of each key of ``ends (row_key, conv_id)``.

    Ids are sorted over the cluster and joined in pieces there. Keys with one
    piece are hashed in place; for others one task reads the pieces in order, one at a time.
    """
    order = ["row_key", "conv_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, key, held, size = TaskContext.get().partitionId(), 0, None, [], 0
        for batch in batches:
            out = []
            for k, conv in zip(batch.column("row_key").to_pylist(), batch.column("conv_id").to_pylist()):
                if held and (k != key or size > PIECE_BYTES):
                    out.append((key, part, piece, ",".join(held)))
                    piece, held, size = piece + 1, [], 0
                key = k
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield _pieces(out)
        if held:
            yield _pieces([(key, part, piece, ",".join(held))])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column("row_key").to_pylist(), batch.column("ids").to_pylist()):
                if k == key:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["row_key", "sha"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["row_key", "sha"])

    ordered = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = staged(ordered.mapInArrow(join, "row_key string, part long, piece long, ids string"), "id-pieces")
    counted = staged(pieces.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"), F.max("ids").alias("ids")), "piece-counts")
    single = counted.filter("n = 1").select("row_key", F.sha2(F.col("ids").cast("binary"), 256).alias("sha"))
    several = pieces.join(counted.filter("n > 1").select("row_key"), "row_key", "left_semi")
    in_order = several.repartition("row_key").sortWithinPartitions("row_key", "part", "piece").select("row_key", "ids")
    return single.unionByName(in_order.mapInArrow(digest, "row_key string, sha string"))


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["row_key", "part", "piece", "ids"])


def prefix_trie(convs: DataFrame, turns: DataFrame, limit: int = CONTAINER_ROWS) -> DataFrame:
    """Nodes of the trie over the turns ``(conv_id, d, id, size)`` of the conversations ``(conv_id)``.

    Sequences are compared by 64-bit turn ids and 128-bit names of whole segments.
    """
    segments = segment_rows(convs, turns)
    rows = distinct_rows(segments)
    total, root_id, last = segments.agg(F.sum((F.col("seg") == 0).cast("long")), F.min("conv_id"), F.max("seg")).first()
    below = None
    if last:  # a first pass finds the nodes of all segments; then what follows each segment is known
        followed = rows.select("row_key", (F.col("seg") + 1).alias("seg"), F.col("next_head").alias("head"))
        more = staged(followed.join(head_children(rows), ["seg", "head"]).select("row_key", F.col("children").alias("more")), "followed")
        zero = F.lit(0).cast("long")
        nodes = trie_nodes(rows, root_id, more.withColumns({"leaves": zero, "saved": zero}), limit)
        below = staged(more.join(_below(segments, nodes), "row_key"), "below")
    nodes = trie_nodes(rows, root_id, below, limit)
    if total:
        nodes = nodes.unionByName(_root(nodes, rows, total, root_id))
    digests = id_digests(segments.filter("last"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    ending = nodes.filter("row_key is not null").join(digests, "row_key", "left").withColumn("ends_sha256", F.coalesce("sha", empty))
    passing = nodes.filter("row_key is null").withColumn("ends_sha256", empty)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return ending.select(*names).unionByName(passing.select(*names))


def _root(nodes: DataFrame, rows: DataFrame, total: int, root_id: int) -> DataFrame:
    """The textless root as a row like those of ``nodes``; a few numbers of it pass the driver."""
    leaves, saved = nodes.agg(
        F.sum((F.col("n_children") == 0).cast("long")), F.sum((F.col("n_convs") - 1) * F.col("size"))
    ).first()
    children = head_children(rows.filter("seg = 0")).agg(F.sum("children")).first()[0] or 0
    bare = rows.filter(F.size("turns") == 0).select("row_key").first()
    row = (0, root_id, None, total, children, leaves or 1, saved or 0, 0, bare and bare[0])
    return nodes.sparkSession.createDataFrame([row], _NODE)


def conversation_trie(conversations: DataFrame, limit: int = CONTAINER_ROWS) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)`` of every node.

    Conversations are rebuilt as ``rebuilt_turns`` says; a node is a distinct
    sequence of their first turns, ``conv_id`` its smallest member, and
    ``saved_tokens`` sums (members - 1) times the bytes of the last text over its
    subtree. Turns go by ``turn`` (null first), ties by role and turn id; repeated rows
    are repeated turns. Null roles and texts are empty; rows without a
    ``conv_id`` belong to no conversation. Other columns are not read. An empty table has no nodes, not even a root.
    """
    return prefix_trie(*rebuilt_turns(conversations), limit)
