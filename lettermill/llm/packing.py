"""Token pieces of documents, packed into fixed-length sequences by the sum-of-squares rule."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lettermill.llm.words import slices
from lettermill.session import staged

CAPACITY = 2048
END_ID = 0
SPECIAL = "<|endoftext|>"
GROUP_PIECES = 50_000  # pieces that one task packs, on average
CLOSING_SHARE = 0.25  # the shortest pieces, which close gaps
ID_BITS = 32  # sequence numbers inside a group


class Encoder:
    """Ids of byte-level BPE files: ``ranks`` for ordinary text, ``vocabulary`` where the special mark occurs.

    Both files hold the same merges, so ids are the same; the first is faster.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.vocabulary = vocabulary

    @cached_property
    def full(self) -> Tokenizer:
        """Only read where a text needs it."""
        return Tokenizer.from_file(self.vocabulary)

    def ids(self, text: str) -> np.ndarray:
        if SPECIAL not in text:
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except (RuntimeError, ValueError):  # the pattern gave up on an extreme run of white space
                pass
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def encoder(vocabulary: str, ranks: str, pattern: str) -> Encoder:
    """One per worker process."""
    return Encoder(vocabulary, ranks, pattern)


def token_pieces(
    docs: DataFrame, files: tuple[str, str, str], capacity: int = CAPACITY, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: the ids of each text and an end id, cut where longer than ``capacity``.

    ``files`` are the paths of the vocabulary and rank files and the pattern
    that splits text. All pieces but the first are full, so a document has one
    piece at most that is shorter. Null texts are empty: one piece, the end id.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*files).ids
        for batch in slices(batches, "t"):
            rows: list[list] = [[] for _ in range(6)]
            for doc, text in zip(batch.column("i").to_pylist(), batch.column("t").to_pylist()):
                ids = np.append(encode(text or ""), END_ID).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                for piece, start in enumerate([0, *range(first, len(ids), capacity)]):
                    part = ids[start : start + capacity if piece else first]
                    values = (doc, piece, start, len(part), zlib.crc32(part), part.tobytes() if with_ids else None)
                    for column, value in zip(rows, values):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
            width = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, k) for r, k in zip(rows[:width], kinds)], list(names[:width])
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).mapInArrow(cut, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece, placed from the longest to the shortest.

    Each goes where the sum over gaps of (open bins with that gap) squared
    becomes smallest; full bins do not count. Ties go to the tightest bin. The
    rule keeps gaps of every size open for pieces to come; the last pieces, a
    ``CLOSING_SHARE`` of all, have nothing to wait for and take the tightest gap.
    """
    bins = np.empty(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = int(np.searchsorted(-lengths[order], -capacity, "right"))
    bins[order[:full]] = np.arange(full)
    used = full
    weight = np.ones(capacity + 1, np.int64)  # 2 * open bins + 1, by gap
    weight[0] = 0
    taken = np.full(capacity + 1, -(1 << 40), np.int64)  # the same where a bin is open
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    closing = len(order) - int((len(order) - full) * CLOSING_SHARE)
    for place, item in enumerate(order[full:].tolist(), full):
        size = int(lengths[item])
        if place < closing:
            change = weight[: capacity - size] - taken[size:capacity]
            best = int(change.argmin()) if len(change) else 0
            fits = len(change) > 0 and change[best] + 2 <= weight[capacity - size]
        else:
            best = int((taken[size:capacity] > 0).argmax()) if size < capacity else 0
            fits = size < capacity and taken[size + best] > 0
        if fits:
            gap = best + size
            where = stacks[gap].pop()
            weight[gap] -= 2
            taken[gap] = weight[gap] if stacks[gap] else -(1 << 40)
        else:
            gap, where, used = capacity, used, used + 1
        bins[item], offsets[item] = where, capacity - gap
        if left := gap - size:
            stacks[left].append(where)
            weight[left] += 2
            taken[left] = weight[left]
    return bins, offsets


def pack(pieces: DataFrame, n: int, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: a place without gap or overlap in sequences of ``capacity``.

    Pieces are dealt by a hash of their content and place into groups of about
    ``GROUP_PIECES``, so tasks keep their size as the data grows; a group leaves
    a few unfilled sequences at most. The sequence number holds the group above
    ``ID_BITS`` bits. Pieces must have 1 to ``capacity`` tokens.
    """
    groups = max(1, -(-n // GROUP_PIECES))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(5)), F.lit(groups)))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "piece"], kind="stable")  # the same result in a repeated task
        bins, offsets = sum_of_squares(group["length"].to_numpy(), capacity)
        group["sequence_id"] = (group["_group"].to_numpy() << ID_BITS) + bins
        group["offset"] = offsets
        return group.drop(columns="_group")

    return dealt.groupBy("_group").applyInPandas(place, _ddl(pieces) + ", sequence_id long, offset long")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def pack_documents(docs: DataFrame, files: tuple[str, str, str], capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack ``docs (doc_id, text)``; one row per piece.

    Every document has at least its end id, so null and empty texts are packed
    too, and repeated rows are packed again. An empty table gives no rows;
    columns other than the two are not read. Rows without an id stay, with a null id.
    """
    pieces = staged(token_pieces(docs, files, capacity), "pieces")
    return pack(pieces, pieces.count(), capacity)
