"""SimHash fingerprints and near-duplicate groups by a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.components import LocalGroups, components
from lettermill.llm.words import slices
from lettermill.session import staged

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
BLOCK_FINGERPRINTS = 16_384  # fingerprints of one top-level node of the index, on average
MAX_PREFIX = 24
LEVEL_BITS = 4
QUERY_CHUNK = 8_192
CANDIDATES = 1 << 18  # nodes that one step of a search looks at
HASH_CHUNK = 65_536
HALF = np.uint64(32)


def fingerprint(text: bytes, width: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of the lower-cased words; a bit is set if set in over half the shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    begins = [0, *accumulate(len(w) + 1 for w in words)]  # the last one ends one past the text
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, HASH_CHUNK):
        upto = min(n, at + HASH_CHUNK)
        ends = begins[at + width : upto + width] if len(words) >= width else begins[-1:]
        codes = b"".join([digest(joined[s : e - 1], seed) for s, e in zip(begins[at:upto], ends)])
        bits = np.unpackbits(np.frombuffer(codes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` of every document; null and wordless texts have fingerprint 0."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            texts = batch.column("t").cast(pa.large_binary()).fill_null(b"")
            values = [fingerprint(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("i").cast(pa.int64()), pa.array(values, pa.int64())], ["doc_id", "fp"]
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    return narrow.mapInArrow(compute, "doc_id long, fp long")


class GrayIndex:
    """Fingerprints in Gray order under nodes that keep the bits all their members share.

    A query goes down level by level and carries the bits in which it differs
    from the shared pattern of a node; once these exceed the limit, the whole
    group below the node is left out.
    """

    def __init__(self, fps: np.ndarray):
        rank = fps.copy()
        for shift in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(shift)
        self.order = np.argsort(rank, kind="stable")
        f = fps[self.order]
        self.levels = []
        for bits in range(0, 64 - LEVEL_BITS + 1, LEVEL_BITS):
            top = f >> np.uint64(64 - bits) if bits else np.zeros(len(f), np.uint64)
            starts = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1])))
            all_set, any_set = np.bitwise_and.reduceat(f, starts), np.bitwise_or.reduceat(f, starts)
            self.levels.append((starts, all_set, ~(all_set ^ any_set)))
            if 2 * len(starts) > len(f):
                break
        self.levels.append((np.arange(len(f)), f, np.full(len(f), ~np.uint64(0))))

        self.children = [
            np.append(np.searchsorted(below[0], above[0]), len(below[0]))
            for above, below in zip(self.levels, self.levels[1:])
        ]

    def within(self, queries: np.ndarray, limit: int, upper_limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) numbers with at most ``limit`` differing bits, ``upper_limit`` of them in the upper half."""
        who, found = zip(*self.pieces_within(queries, limit, upper_limit))
        return np.concatenate(who), np.concatenate(found)

    def pieces_within(
        self, queries: np.ndarray, limit: int, upper_limit: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``within``, piece by piece, one at least.

        A step looks at ``CANDIDATES`` nodes at most, or at the children of one
        node; the rest waits on its level. So memory does not follow the
        number of pairs in a dense block.
        """
        yield np.zeros(0, np.int64), np.zeros(0, np.int64)
        work = [(0, np.arange(len(queries)), np.zeros(len(queries), np.int64))]
        while work:
            depth, who, node = work.pop()
            first, n = self.children[depth][node], self.children[depth][node + 1] - self.children[depth][node]
            upto = np.cumsum(n)
            if len(who) and upto[-1] > CANDIDATES:
                cut = max(1, int(np.searchsorted(upto, CANDIDATES, "right")))
                if cut < len(who):
                    work.append((depth, who[cut:], node[cut:]))
                who, first, n, upto = who[:cut], first[:cut], n[:cut], upto[:cut]
            who = np.repeat(who, n)
            node = np.arange(len(who)) - np.repeat(upto - n - first, n)
            _, pattern, shared = self.levels[depth + 1]
            differ = (queries[who] ^ pattern[node]) & shared[node]
            keep = (np.bitwise_count(differ) <= limit) & (np.bitwise_count(differ >> HALF) <= upper_limit)
            who, node = who[keep], node[keep]
            if depth + 2 == len(self.levels):
                yield who, self.order[node]
            elif len(who):
                work.append((depth + 1, who, node))


def link_block(ids: np.ndarray, fps: np.ndarray, is_member: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (id, smaller id) that join what the members and queries of one block link: a star per group."""
    known, local = np.unique(ids, return_inverse=True)
    groups = LocalGroups(len(known))
    member = np.flatnonzero(is_member)
    if len(member):
        index = GrayIndex(fps[member])
        for at in range(0, len(fps), QUERY_CHUNK):
            for who, found in index.pieces_within(fps[at : at + QUERY_CHUNK], limit, limit // 2):
                groups.unite(local[who + at], local[member[found]])
    items, labels = groups.links()
    return known[items], known[labels]


def near_links(fps: DataFrame, n: int, limit: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints of ``fps (rep, fp)`` within ``limit`` bits.

    With ``limit`` differing bits, one half of the fingerprint has at most
    ``limit // 2`` of them. So the index is built over the fingerprint and over
    its swapped halves; its upper nodes are the blocks of equal leading bits,
    spread over the cluster. A fingerprint is a member of its own block and a
    query to the blocks whose leading bits differ in one place (limits 2 and 3).
    Of two such blocks only one sends to the other. Blocks keep their average
    size as the data grows, and each returns a spanning star per group, never pairs.
    """
    if not 0 <= limit <= 3:
        raise ValueError("limit must be 0 to 3")
    prefix = min(MAX_PREFIX, max(0, int(np.ceil(np.log2(max(1, n) / BLOCK_FINGERPRINTS)))))
    swapped = F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
    views = fps.select("rep", F.inline(F.array(*[
        F.struct(F.lit(v).alias("view"), f.alias("fp")) for v, f in enumerate((F.col("fp"), swapped))
    ])))
    block = F.shiftrightunsigned("fp", 64 - prefix) if prefix else F.lit(0).cast("long")
    targets = [F.struct(F.col("block"), F.lit(True).alias("is_member"))]
    for bit in range(prefix if limit > 1 else 0):
        flipped = F.col("block").bitwiseXOR(F.lit(1 << bit))
        targets.append(F.when(F.col("block").bitwiseAND(F.lit(1 << bit)) != 0, F.struct(flipped.alias("block"), F.lit(False).alias("is_member"))))
    routed = views.withColumn("block", block).select("rep", "view", "fp", F.inline(F.filter(F.array(*targets), lambda t: t.isNotNull())))

    def link(group: pd.DataFrame) -> pd.DataFrame:
        a, b = link_block(
            group["rep"].to_numpy(), group["fp"].to_numpy().view(np.uint64), group["is_member"].to_numpy(), limit
        )
        return pd.DataFrame({"a": a, "b": b})

    return routed.groupBy("view", "block").applyInPandas(link, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row of ``docs``.

    Documents link if their fingerprints differ in at most ``limit`` bits;
    ``component_id`` is the smallest id reachable. Equal fingerprints are
    grouped first, so a group of copies of any size is one member of the index.
    Null or empty texts have fingerprint zero and link like any other. Repeated
    rows stay repeated. A ``doc_id`` with several texts counts as one document.
    Rows without an id get the component of their fingerprint (null if no row
    with an id has it). Other columns are not read; an empty table gives no rows.
    """
    fps = staged(with_fingerprints(docs, id_col, text_col), "fingerprints")
    reps = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-reps")
    known = reps.filter("rep is not null")
    found = components(near_links(known, known.count(), limit))
    named = reps.join(found, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
