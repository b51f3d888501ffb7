"""Repeated word sequences found by hashes of content-cut blocks, then of single windows.

The corpus is cut by content into blocks: a block is a run of consecutive
windows (of ``window`` words) that share one anchor, the smallest hash among
the grams inside each window. Equal windows choose the same anchor, so they lie
in blocks with the same anchor hash, wherever they occur. A block whose whole
word sequence occurs earlier is a duplicate span as it is. Of the other blocks
every window is looked up by itself. There is no greedy longest-match parse:
no match is extended against a reference.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.llm.words import Words, mix, run_hashes, slices, split_words, text_bytes, word_hashes
from lettermill.session import staged

WINDOW = 20
GRAM = 6
FLUSH_WINDOWS = 2_000_000  # windows that a task judges among themselves before it sends the rest on
FILTER_BITS = 29  # upper bound: 64 MB
FILTER_SLICES = 9  # bits of the slice number; slices are made on executors
LAST_ID = (1 << 63) - 1  # stands for a null id


class Blocks:
    """Blocks of the documents of one slice, as arrays: document row, first window, number of windows, anchor hash."""

    def __init__(self, words: Words, window: int, gram: int):
        self.hashes = word_hashes(words)
        n, width = len(self.hashes), window - gram + 1
        n_windows = max(0, n - window + 1)
        self.row_of_word = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        starts = np.arange(n_windows)
        if not n_windows:
            self.first = self.size = self.row = starts
            self.anchor = self.hashes[:0]
            return
        grams = run_hashes(self.hashes, np.arange(n - gram + 1), np.arange(gram, n + 1))
        least, reach = np.arange(len(grams)), 1  # position of the leftmost smallest of `reach` grams
        while reach < width:
            step = min(reach, width - reach)
            left, right = least[: len(least) - step], least[step:]
            least, reach = np.where(grams[right] < grams[left], right, left), reach + step
        inside = self.row_of_word[:n_windows] == self.row_of_word[window - 1 :]
        valid = np.flatnonzero(inside)
        anchors, rows = least[valid], self.row_of_word[valid]
        new = np.ones(len(valid), bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])
        heads = np.flatnonzero(new)
        self.first = valid[heads]
        self.size = np.diff(np.append(heads, len(valid)))
        self.row = rows[heads]
        self.anchor = mix(grams[anchors[heads]])


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text and the text's hash: rows of one id, or of none, are one document only if their texts are equal."""
    text = F.col(text_col)
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("i"), F.xxhash64(text).alias("h"), text.alias("t"))


def anchor_counts(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``(anchor, n)`` of all blocks, one row per anchor and task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in slices(batches, "t"):
            held.append(Blocks(split_words(batch.column("t")), window, gram).anchor)
            if sum(map(len, held)) >= FLUSH_WINDOWS:
                yield _counted(held)
                held = []
        if held:
            yield _counted(held)

    counted = docs.mapInArrow(count, "anchor long, n long")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n"))


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    values, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["anchor", "n"])


def repeated_anchor_filter(counts: DataFrame) -> tuple[np.ndarray, int]:
    """Bits of the anchors that occur twice or more, and the number of address bits.

    It only saves work: an anchor that shares its bit with a repeated one passes
    and is judged exactly later. Its size is bounded by ``FILTER_BITS`` whatever
    the corpus; slices of it are filled on the executors.
    """
    repeated = staged(counts.filter("n > 1").select("anchor"), "repeated-anchors")
    bits = int(np.clip(np.ceil(np.log2(16 * max(1, repeated.count()))), FILTER_SLICES + 6, FILTER_BITS))
    slot = F.shiftrightunsigned("anchor", 64 - bits)
    slice_bits = bits - FILTER_SLICES

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros(1 << slice_bits, np.uint8)
        part[group["slot"].to_numpy() & ((1 << slice_bits) - 1)] = 1
        return pd.DataFrame({"slice": group["slice"].iloc[:1], "part": [np.packbits(part).tobytes()]})

    slots = repeated.select(slot.alias("slot")).distinct()
    parts = (
        slots.withColumn("slice", F.shiftright("slot", slice_bits))
        .groupBy("slice").applyInPandas(fill, "slice long, part binary").collect()  # FILTER_BITS bits in all
    )
    filled = np.zeros((1 << FILTER_SLICES, (1 << slice_bits) // 8), np.uint8)
    for row in parts:
        filled[row["slice"]] = np.frombuffer(row["part"], np.uint8)
    return filled.reshape(-1), bits


def candidate_blocks(docs: DataFrame, bits: np.ndarray, address: int, window: int, gram: int) -> DataFrame:
    """Blocks whose anchor passes the filter: ``(key, doc, version, start, n, windows, known)``.

    ``key`` is the hash of the block's words. A task first judges its blocks and
    windows among themselves: all but the first of equal ones are duplicates
    whatever else the corpus holds, and leave as ``known`` spans without a key
    in common. So a sequence in any number of documents is sent on once per flush.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in slices(batches, "t"):
            held.append(_candidates(batch, shared.value, address, window, gram))
            if sum(len(h[-1]) for h in held) >= FLUSH_WINDOWS:
                yield _judged(held)
                held = []
        if held:
            yield _judged(held)

    schema = "key long, doc long, version long, start int, n int, windows array<long>, known boolean"
    return docs.mapInArrow(find, schema)


def _candidates(batch: pa.RecordBatch, bits: np.ndarray, address: int, window: int, gram: int):
    """Block key, document and its text's hash, first window in it, number of windows; and the hashes of all their windows."""
    words = split_words(batch.column("t"))
    blocks = Blocks(words, window, gram)
    slot = blocks.anchor >> np.uint64(64 - address)
    keep = (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8))) & 1
    keep = keep.astype(bool)
    first, size, row = blocks.first[keep], blocks.size[keep], blocks.row[keep]
    at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    doc, version = (batch.column(c).to_numpy()[row] if len(row) else np.zeros(0, np.int64) for c in ("i", "h"))
    return (
        run_hashes(blocks.hashes, first, first + size + window - 1),
        doc, version, first - words.first[row], size, run_hashes(blocks.hashes, at, at + window),
    )


def _later(key: np.ndarray, doc: np.ndarray, version: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which items have an equal key in a smaller doc, or earlier in the same text of the same doc."""
    order = np.lexsort((start, version, doc, key))
    k, d, v, s = key[order], doc[order], version[order], start[order]
    new, fresh = np.ones(len(k), bool), np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    fresh[1:] = new[1:] | (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    first = lambda heads: np.maximum.accumulate(np.where(heads, np.arange(len(k)), 0))
    later = np.zeros(len(k), bool)
    later[order] = (d != d[first(new)]) | (s != s[first(fresh)])
    return later


def _judged(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    key, doc, version, start, size, windows = (np.concatenate(x) for x in zip(*held))
    bounds = np.append(0, np.cumsum(size))
    known = _later(key, doc, version, start)
    ahead = np.repeat(~known, size)  # windows of blocks that are not duplicates here
    w_doc, w_version = np.repeat(doc, size)[ahead], np.repeat(version, size)[ahead]
    w_start = (np.repeat(start - bounds[:-1], size) + np.arange(bounds[-1]))[ahead]
    w_known = np.zeros(bounds[-1], bool)
    w_known[ahead] = _later(windows[ahead], w_doc, w_version, w_start)
    runs_doc, runs_version, runs_start = (x[w_known[ahead]] for x in (w_doc, w_version, w_start))
    head = np.ones(len(runs_doc), bool)
    head[1:] = (runs_doc[1:] != runs_doc[:-1]) | (runs_version[1:] != runs_version[:-1]) | (runs_start[1:] != runs_start[:-1] + 1)
    heads = np.flatnonzero(head)
    # rows: open blocks with their windows, then known blocks and known runs of windows
    open_size = size[~known]
    docs = np.concatenate((doc[~known], doc[known], runs_doc[heads]))
    versions = np.concatenate((version[~known], version[known], runs_version[heads]))
    starts = np.concatenate((start[~known], start[known], runs_start[heads]))
    sizes = np.concatenate((open_size, size[known], np.diff(np.append(heads, len(runs_doc)))))
    n_open, n_known = len(open_size), len(docs) - len(open_size)
    keys = np.concatenate((key[~known], mix(docs[n_open:].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + starts[n_open:].astype(np.uint64))))
    offsets = np.concatenate((np.append(0, np.cumsum(open_size)), np.full(n_known, open_size.sum()))).astype(np.int32)
    values = pa.array(windows[ahead].view(np.int64), mask=w_known[ahead])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys.view(np.int64)), pa.array(docs), pa.array(versions), pa.array(starts.astype(np.int32)), pa.array(sizes.astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(np.arange(len(docs)) >= n_open),
        ],
        ["key", "doc", "version", "start", "n", "windows", "known"],
    )


def duplicate_factors(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Factors ``(doc, version, start, n)``: ``n`` windows from word ``start`` whose words also start earlier.

    Earlier is a smaller id, or the same document at a smaller word number. The
    factors of a document cover all such windows; they may touch or overlap.
    ``doc`` is the id, ``LAST_ID`` for a null id, ``version`` the hash of the text.
    Sequences are compared by 64-bit hashes of their words.
    """
    texts = _narrow(docs, id_col, text_col)
    bits, address = repeated_anchor_filter(anchor_counts(texts, window, gram))
    blocks = candidate_blocks(texts, bits, address, window, gram)
    judged = staged(
        blocks.withColumn("factor", F.col("known") | _is_later("key"))
        .withColumn("windows", F.when(~F.col("factor"), F.col("windows")))
        .drop("key", "known"),
        "blocks",
    )
    place = ("doc", "version", "start")
    single = (
        judged.filter(~F.col("factor"))
        .select(*place, F.posexplode("windows").alias("at", "hash"))
        .filter("hash is not null")
        .select("doc", "version", (F.col("start") + F.col("at")).alias("start"), "hash")
        .withColumn("later", _is_later("hash"))
        .filter("later")
        .select(*place, F.lit(1).alias("n"))
    )
    return judged.filter("factor").select(*place, "n").union(single)


def _is_later(key: str) -> Column:
    """``_later`` over the cluster: one shuffle and one sort by the key serve both windows."""
    every = Window.partitionBy(key).orderBy("doc", "version", "start")
    same = Window.partitionBy(key, "doc", "version").orderBy("start")
    return (F.col("doc") > F.first("doc").over(every)) | (F.rank().over(same) > 1)


def remove_factors(
    docs: DataFrame, factors: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``text`` less the words under ``factors``, and ``n_words``, ``n_removed``, ``kept_sha256``.

    The text keeps its white space where no word goes; a removed run goes with
    the space behind it. ``kept_sha256`` is of the kept words joined by a space.
    """
    spans = factors.groupBy(F.col("doc").alias("_doc"), F.col("version").alias("_text")).agg(
        F.collect_set(F.struct("start", "n")).alias("_spans")  # of one text; its copies have the same
    )
    spans = spans.select("_doc", "_text", F.col("_spans.start").alias("_starts"), F.col("_spans.n").alias("_sizes"))
    added = ("n_words", "n_removed", "kept_sha256")
    kept = docs.drop(*added).withColumn("_key", F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)))
    kept = kept.join(spans, (F.col("_key") == F.col("_doc")) & (F.xxhash64(text_col) == F.col("_text")), "left")
    names = [c for c in docs.columns if c not in added]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            column = batch.column(text_col)
            data, bounds = text_bytes(column)
            words = split_words(column)
            texts, totals, removed, digests = [], [], [], []
            starts, sizes = batch.column("_starts").to_pylist(), batch.column("_sizes").to_pylist()
            for row, present in enumerate(column.is_valid().to_pylist()):
                low, high = words.first[row], words.first[row + 1]
                text = data[bounds[row] : bounds[row + 1]].tobytes()
                gone = np.zeros(high - low, bool)
                if starts[row]:
                    depth = np.zeros(high - low + 1, np.int64)
                    at = np.minimum(np.array(starts[row]), high - low)
                    np.add.at(depth, at, 1)
                    np.add.at(depth, np.minimum(at + np.array(sizes[row]) + window - 1, high - low), -1)
                    gone = np.cumsum(depth)[:-1] > 0
                kept_words = text.split()
                if gone.any():
                    begin = words.starts[low:high] - bounds[row]
                    until = np.append(begin[1:], len(text))
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], ~gone, [False]))))
                    lead = text[: begin[0]]
                    text = lead + b"".join(text[begin[a] : until[b - 1]] for a, b in zip(edge[::2], edge[1::2]))
                    kept_words = [w for w, g in zip(kept_words, gone.tolist()) if not g]
                texts.append(text if present else None)
                totals.append(high - low)
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(b" ".join(kept_words)).hexdigest())
            arrays = [pa.array(texts, pa.binary()).cast(pa.string()) if c == text_col else batch.column(c) for c in names]
            arrays += [pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [*names, *added])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in names)
    return kept.select(*names, "_starts", "_sizes").mapInArrow(
        cut, schema + ", n_words long, n_removed long, kept_sha256 string"
    )


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` less the words covered by a window that also starts earlier.

    Windows are judged on the input. Null and short texts lose nothing; a null
    text stays null and has the digest of no words. Rows of one id are not earlier
    than each other: repeated rows are one document, different texts are judged
    each by itself. So are rows without an id, which come after all others.
    Other columns stay; an input column named like an added one is replaced.
    """
    return remove_factors(docs, duplicate_factors(docs, window, GRAM, id_col, text_col), window, id_col, text_col)
