"""Fixed-length token sequences for causal training.

The vocabulary size is a parameter, so the vocabulary is bounded whatever the
corpus. What it lacks is spelled out in bytes and white space is kept, so a
sequence can be decoded to its text. Tokens are looked up by an Arrow dictionary
kernel on whole batches; the alternative (explode, join, collect) would shuffle
every token of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.functions.fixed_values import MAX_LENGTH
from lettermill.functions.text import WORD
from lettermill.operators.chats import DEFAULT_TEMPLATE, ChatTemplate
from lettermill.plans.levels import joined_in_levels

VOCABULARY_SIZE = 32_000
SLICE_TOKENS = 1 << 16  # tokens of a batch that a worker handles at a time, and one row
END_ID = 0  # also the padding
FIRST_BYTE_ID = 1
FIRST_ID = FIRST_BYTE_ID + 256
TOKEN = rf"(?U)<\|[a-z]+\|>| ?[{WORD}]+|[^{WORD}]"


def tokens(text: Column) -> Column:
    """Chat marks, words with the space before them, and single other characters: all of the text, in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def build_vocab(texts: DataFrame, text: str = "text", size: int = VOCABULARY_SIZE) -> DataFrame:
    """The ``size`` most frequent tokens with their ids; equal counts in token order.

    The best ``size`` are taken by every task from its rows and then from theirs,
    so only they are numbered.
    """
    counts = (
        texts.select(F.explode(tokens(F.col(text))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.orderBy(F.desc("n"), "token").limit(size)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "token"))  # `size` rows
    return best.select("token", "n", (rank + (FIRST_ID - 1)).cast("int").alias("token_id"))


@lru_cache(maxsize=4)
def _dictionary(words: tuple[str, ...]) -> pa.Array:
    """One per worker process and vocabulary."""
    return pa.array(words, pa.string())


def _in_slices(batch: pa.Array, use: Callable[[pa.Array], pa.Array], kind: pa.DataType) -> pa.Array:
    """``use`` of all rows of a batch of lists, some at a time: what it needs per token exists for one slice only.

    A slice ends with the row that takes it past ``SLICE_TOKENS``.
    """
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    done, start = [], 0
    while start < len(batch):
        before = ends[start - 1] if start else 0
        stop = min(int(np.searchsorted(ends, before + SLICE_TOKENS)) + 1, len(batch))
        done.append(use(batch.slice(start, stop - start)))
        start = stop
    return pa.concat_arrays(done) if done else pa.array([], kind)


def token_lookup(vocab: DataFrame):
    """UDF from token arrays to id arrays; the vocabulary travels with it.

    A token outside the vocabulary gives one id for every byte of its UTF-8 form.
    """
    words = tuple(r["token"] for r in vocab.orderBy("token_id").select("token").collect())  # at most `size`

    def found(rows: pa.Array) -> pa.Array:
        flat = rows.flatten()
        known = pc.index_in(flat, value_set=_dictionary(words))
        ids = pc.fill_null(pc.add(known, FIRST_ID), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        counts = np.ones(len(ids), np.int64)
        missing = np.flatnonzero(ids == 0)
        spelled = [t.encode() for t in flat.take(pa.array(missing)).to_pylist()]
        counts[missing] = [len(t) for t in spelled]
        ids = np.repeat(ids, counts)
        ids[ids == 0] = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int64) + FIRST_BYTE_ID
        lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        bounds = np.append(0, np.cumsum(counts))[np.append(0, np.cumsum(lengths))]
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))

    @F.arrow_udf("array<int>")
    def lookup(batch: pa.Array) -> pa.Array:
        return _in_slices(batch, found, pa.list_(pa.int32()))

    return lookup


def token_decoder(vocab: DataFrame):
    """UDF from id arrays back to the text; padding and ends are skipped, cut characters become U+FFFD."""
    words = tuple(r["token"] for r in vocab.orderBy("token_id").select("token").collect())  # at most `size`

    @F.arrow_udf("string")
    def decode(batch: pa.Array) -> pa.Array:
        parts = [b"", *[bytes([b]) for b in range(256)], *[w.encode() for w in words]]

        def joined(rows: pa.Array) -> pa.Array:
            texts = [None if ids is None else b"".join([parts[i] for i in ids]).decode("utf-8", "replace") for ids in rows.to_pylist()]
            return pa.array(texts, pa.string())

        return _in_slices(batch, joined, pa.string())

    return decode


def decode_sequences(sequences: DataFrame, vocab: DataFrame, *keep: str, ids: str = "input_ids") -> DataFrame:
    """Text of encoded sequences, up to the length they were cut to. Narrow: no shuffle."""
    return sequences.select(*keep, token_decoder(vocab)(F.col(ids)).alias("text"))


def pad(ids: Column, max_length: int) -> dict[str, Column]:
    """Fixed-length columns; labels keep the padding ids."""
    missing = F.lit(max_length) - F.size(ids)
    padded = F.concat(ids, F.array_repeat(F.lit(END_ID), missing))
    return {
        "input_ids": padded,
        "attention_mask": F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), missing)),
        "labels": padded,
    }


def encode_ids(texts: DataFrame, vocab: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """All ids of every text as ``input_ids``, neither cut nor padded. Narrow: no shuffle."""
    return texts.select(*keep, token_lookup(vocab)(tokens(F.coalesce(F.col(text), F.lit("")))).alias("input_ids"))


def encode_sequences(
    texts: DataFrame,
    vocab: DataFrame,
    *keep: str,
    text: str = "text",
    max_length: int = MAX_LENGTH,
) -> DataFrame:
    """Look up, truncate to ``max_length`` ids, pad right. Narrow: no shuffle."""
    cut = F.slice(tokens(F.coalesce(F.col(text), F.lit(""))), 1, max_length)  # each token has one id at least
    ids = texts.select(*keep, F.slice(token_lookup(vocab)(cut), 1, max_length).alias("_ids"))
    return ids.select(*keep, *[c.alias(n) for n, c in pad(F.col("_ids"), max_length).items()])


def encode_conversations(
    turns: DataFrame,
    vocab: DataFrame,
    *keep: str,
    conv: str = "conv_id",
    template: ChatTemplate = DEFAULT_TEMPLATE,
    max_length: int = MAX_LENGTH,
) -> DataFrame:
    """Render and encode turn rows, one sequence per conversation; other columns go.

    Every turn is encoded by itself; ids of neighbouring turns are joined in
    levels and cut to ``max_length``, so only numbers are shuffled and the turns
    of an endless conversation are shared by many tasks. ``keep`` columns must
    be constant in a conversation.
    """
    segments = tokens(template.turn(F.col("role"), F.col("text")))
    ids = turns.select(
        conv, *keep, "turn", F.slice(token_lookup(vocab)(F.slice(segments, 1, max_length)), 1, max_length).alias("_ids")
    )
    joined = joined_in_levels(ids, [conv, *keep], "turn", "_ids", lambda parts: F.slice(F.flatten(parts), 1, max_length))
    return joined.select(conv, *keep, *[c.alias(n) for n, c in pad(F.col("_ids"), max_length).items()])
