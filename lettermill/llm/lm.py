"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, mapped by workers.

The model lies in files of the shared folder (``spark.checkpoint.dir``), which
must be a mounted path on every machine. Each file is one shard with sorted
64-bit hashes and counts; a worker maps the shards it looks into, and looks
hashes up in order, so pages are read once and in sequence. Nothing of the
model passes through the driver but a few sums.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import unquote, urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.llm.words import mix, slices, split_words, word_hashes
from lettermill.session import scratch_path

START = np.uint64(0x5354415254000001)
END = np.uint64(0x454E440000000001)
FLUSH_TOKENS = 2_500_000  # tokens that a task counts before it sends them on
SCORE_TOKENS = 500_000  # tokens whose hashes are looked up together
SHARD_BYTES = 8 << 20  # text per shard of the model, about
MAX_SHARD_BITS = 14
HEADER = 512  # bytes that name the arrays of a file
SALT = np.uint64(63)  # followers of one word are spread over so many shards and one


def pair_key(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + after)


def pair_shard(before: np.ndarray, after: np.ndarray, bits: int) -> np.ndarray:
    """By the word before and a few bits of the word: frequent words do not fill one shard."""
    return top_bits(mix(before + (after & SALT) * np.uint64(0xD6E8FEB86659FD93)), bits)


def top_bits(values: np.ndarray, bits: int) -> np.ndarray:
    return (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash of the token before, and hash of the token: the lower-cased words and one end of every text."""
    words = split_words(column, lower=True)
    n = len(words.first) - 1
    rows = np.repeat(np.arange(n), np.diff(words.first) + 1)
    after = np.full(len(rows), END)
    ends = words.first[1:] + np.arange(n)
    is_word = np.ones(len(rows), bool)
    is_word[ends] = False
    after[is_word] = word_hashes(words)
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[words.first[:-1] + np.arange(n)] = START
    return rows, before, after


def _pack(*arrays: np.ndarray) -> bytes:
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def _unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, np.int64, len(kinds))
    at, out = 8 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _write(path: str, *arrays: np.ndarray) -> None:
    """A file of arrays; written beside its place and moved, so a repeated task does no harm."""
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        header = " ".join(f"{a.dtype.str}:{len(a)}" for a in arrays).encode()
        out.write(header.ljust(HEADER))
        for a in arrays:
            out.write(a.tobytes() + bytes(-a.nbytes % 8))
    os.replace(own, path)


@lru_cache(maxsize=8192)
def _mapped(path: str) -> tuple[np.ndarray, ...] | None:
    """Arrays of a shard, mapped into memory; None if the shard holds nothing."""
    if not os.path.exists(path):
        return None
    data = np.memmap(path, np.uint8, "r")
    at, out = HEADER, []
    for part in bytes(data[:HEADER]).decode().split():
        kind, _, n = part.partition(":")
        size = int(n) * np.dtype(kind).itemsize
        out.append(data[at : at + size].view(kind))
        at += size + -size % 8
    return tuple(out)


SPLIT = (np.uint8, np.uint32, np.uint64)  # kinds of what ``_split`` returns


def _split(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts in one byte each; 255 and more stand aside, with their places."""
    at = np.flatnonzero(counts >= 255)
    return np.minimum(counts, 255).astype(np.uint8), at.astype(np.uint32), counts[at].astype(np.uint64)


def _joined(low: np.ndarray, at: np.ndarray, large: np.ndarray) -> np.ndarray:
    counts = low.astype(np.int64)
    counts[at] = large
    return counts


def _taken(low: np.ndarray, at: np.ndarray, large: np.ndarray, place: np.ndarray) -> np.ndarray:
    counts = low[place].astype(np.int64)
    aside = counts == 255
    if aside.any():
        counts[aside] = large[np.searchsorted(at, place[aside])]
    return counts


def shared_folder(spark, name: str) -> str:
    """New folder that Python on every machine can open below the session's shared one."""
    parts = urlsplit(scratch_path(spark, name))
    if parts.scheme not in ("", "file"):
        raise ValueError(f"the model is mapped into memory: spark.checkpoint.dir must be a mounted path, not {parts.scheme}:")
    path = unquote(parts.path)
    os.makedirs(path, exist_ok=True)
    return path


def discounts(n: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from the numbers of types that occur 1 to 4 times."""
    n1, n2, n3, n4 = (max(1, x) for x in n)
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *[float(np.clip(d, 0.1 * (i + 1), 0.95 * (i + 1))) for i, d in enumerate(raw)]])


@dataclass(frozen=True)
class KneserNey:
    """Where the shards lie, and the sums that every probability needs."""

    folder: str
    pair_bits: int
    word_bits: int
    train_tokens: int
    types: int
    contexts: int  # different pairs
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    word_backoff: float

    def _lookup(self, kind: str, hashes: np.ndarray, shard: np.ndarray, width: int) -> list[np.ndarray]:
        """Arrays of the shards at sorted unique ``hashes``; 0 where unknown."""
        out = [np.zeros(len(hashes), np.int64) for _ in range(width)]
        order = np.argsort(shard, kind="stable")
        bounds = np.append(np.flatnonzero(np.diff(shard[order], prepend=-1)), len(order))
        for a, b in zip(bounds[:-1], bounds[1:]):
            at = order[a:b]
            arrays = _mapped(f"{self.folder}/{kind}-{shard[at[0]]}")
            if arrays is None:
                continue
            place = np.minimum(np.searchsorted(arrays[0], hashes[at]), len(arrays[0]) - 1)
            known = arrays[0][place] == hashes[at]
            for i, target in enumerate(out):
                target[at[known]] = _taken(*arrays[1 + 3 * i : 4 + 3 * i], place[known])
        return out

    def log10(self, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every token its training count, base log-probability, and log-probability by the model."""
        words, where = np.unique(np.concatenate((before, after)), return_inverse=True)
        before_at, after_at = where[: len(before)], where[len(before) :]
        count, follows, one, two, more = self._lookup("words", words, top_bits(words, self.word_bits), 5)
        base = np.log10((count + 0.5) / (self.train_tokens + 0.5 * (self.types + 1)))
        d = self.word_discounts
        lower = np.maximum(follows - d[np.minimum(follows, 3)], 0) / max(1, self.contexts)
        lower = lower + self.word_backoff / (self.types + 1)
        total = count.copy()  # a word is followed as often as it occurs; the start as often as the end occurs
        ends = self._lookup("words", np.array([END]), top_bits(np.array([END]), self.word_bits), 1)[0][0]
        total[words == START] = ends
        total[words == END] = 0
        d = self.pair_discounts
        backoff = np.where(total > 0, (d[1] * one + d[2] * two + d[3] * more) / np.maximum(1, total), 1.0)
        keys, at = np.unique(pair_key(before, after), return_inverse=True)
        shard = np.empty(len(keys), np.int64)
        shard[at] = pair_shard(before, after, self.pair_bits)
        n = self._lookup("pairs", keys, shard, 1)[0][at]
        seen = np.maximum(n - d[np.minimum(n, 3)], 0) / np.maximum(1, total[before_at])
        p = seen + backoff[before_at] * lower[after_at]
        return count[after_at], base[after_at], np.log10(p)


def fit(docs: DataFrame, text_col: str = "text") -> KneserNey:
    """Count all of ``docs``; null texts are empty. Shards follow the size of the text.

    A task counts pairs and sends them sorted, one block per shard, with every
    word before written once. A shard merges its blocks, writes its hashes and
    counts, and sends on what its pairs say about each word: count, number of
    different words before it, number of followers seen once, twice, more often.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    bits = min(MAX_SHARD_BITS, max(0, int(np.ceil(np.log2(max(1, size) / SHARD_BYTES)))))
    folder = shared_folder(spark, "language-model")
    blocks = docs.select(F.col(text_col).alias("t")).mapInArrow(_pair_blocks(bits), "shard int, block binary")
    merged = blocks.groupBy("shard").applyInPandas(
        _write_pairs(folder, bits), "shard int, block binary, n1 long, n2 long, n3 long, n4 long"
    )
    rows = merged.groupBy("shard").applyInPandas(
        _write_words(folder),
        "types long, tokens long, contexts long, w1 long, w2 long, w3 long, w4 long, more long, n1 long, n2 long, n3 long, n4 long",
    )
    names = rows.columns
    sums = {c: int(s or 0) for c, s in zip(names, rows.agg(*[F.sum(c) for c in names]).first())}
    words = discounts([sums[f"w{i}"] for i in range(1, 5)])
    left = words[1] * sums["w1"] + words[2] * sums["w2"] + words[3] * sums["more"]
    return KneserNey(
        folder, bits, bits, sums["tokens"], sums["types"], sums["contexts"],
        discounts([sums[f"n{i}"] for i in range(1, 5)]), words, left / sums["contexts"] if sums["contexts"] else 1.0,
    )


def _merged_pairs(v: np.ndarray, w: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs in order, and how often each occurs (or the sum of ``n``)."""
    order = np.lexsort((w, v))
    v, w = v[order], w[order]
    fresh = np.append(True, (v[1:] != v[:-1]) | (w[1:] != w[:-1]))[: len(v)]
    heads = np.flatnonzero(fresh)
    counts = np.diff(np.append(heads, len(v))) if n is None else np.add.reduceat(n[order], heads) if len(heads) else n[:0]
    return v[heads], w[heads], counts


def _pair_blocks(bits: int):
    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        v, w = (np.concatenate(x) for x in zip(*held))
        held.clear()
        v, w, n = _merged_pairs(v, w)
        shard = pair_shard(v, w, bits)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange((1 << bits) + 1))
        shards, blocks = [], []
        for s in range(1 << bits):
            at = order[bounds[s] : bounds[s + 1]]
            if len(at):
                head = np.flatnonzero(np.append(True, v[at][1:] != v[at][:-1]))
                runs = np.diff(np.append(head, len(at)))
                shards.append(s)
                blocks.append(_pack(v[at][head], *_split(runs), w[at], *_split(n[at])))
        return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(blocks, pa.binary())], ["shard", "block"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, "t"):
            _, before, after = tokens(batch.column("t"))
            held.append((before, after))
            size += len(after)
            if size >= FLUSH_TOKENS:
                yield flush(held)
                size = 0
        if held:
            yield flush(held)

    return count


def _write_pairs(folder: str, bits: int):
    def write(group: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack(b, np.uint64, *SPLIT, np.uint64, *SPLIT) for b in group["block"]]
        v, w, n = _merged_pairs(
            np.concatenate([np.repeat(p[0], _joined(*p[1:4])) for p in parts]), np.concatenate([p[4] for p in parts]),
            np.concatenate([_joined(*p[5:8]) for p in parts]),
        )
        keys = pair_key(v, w)
        order = np.argsort(keys)
        _write(f"{folder}/pairs-{group['shard'].iloc[0]}", keys[order], *_split(n[order]))
        words, at = np.unique(np.concatenate((w, v)), return_inverse=True)
        as_word, as_context = at[: len(w)], at[len(w) :]
        add = lambda where, weights: np.bincount(where, weights, len(words)).astype(np.int64)
        sums = [add(as_word, n), np.bincount(as_word, minlength=len(words))]
        sums += [add(as_context, k) for k in (n == 1, n == 2, n >= 3)]
        shard = top_bits(words, bits)
        bounds = np.searchsorted(shard, np.arange((1 << bits) + 1))
        found = [s for s in range(1 << bits) if bounds[s] < bounds[s + 1]]
        out = pd.DataFrame({
            "shard": found,
            "block": [
                _pack(words[bounds[s] : bounds[s + 1]], *[a for x in sums for a in _split(x[bounds[s] : bounds[s + 1]])]) for s in found
            ],
        })
        for i in range(1, 5):
            out[f"n{i}"] = 0
            out.loc[0, f"n{i}"] = int((n == i).sum())
        return out

    return write


def _write_words(folder: str):
    def write(group: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack(b, np.uint64, *SPLIT * 5) for b in group["block"]]
        words = np.concatenate([p[0] for p in parts])
        order = np.argsort(words, kind="stable")
        words = words[order]
        heads = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
        sums = [np.add.reduceat(np.concatenate([_joined(*p[i : i + 3]) for p in parts])[order], heads) for i in range(1, 16, 3)]
        _write(f"{folder}/words-{group['shard'].iloc[0]}", words[heads], *[a for x in sums for a in _split(x)])
        count, follows = sums[:2]
        row = {"types": int((count > 0).sum()), "tokens": int(count.sum()), "contexts": int(follows.sum())}
        row |= {f"w{i}": int((follows == i).sum()) for i in range(1, 5)} | {"more": int((follows >= 3).sum())}
        row |= {f"n{i}": int(group[f"n{i}"].sum()) for i in range(1, 5)}
        return pd.DataFrame([row])

    return write


def with_scores(docs: DataFrame, model: KneserNey, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, and ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``perplexity``.

    Scores are base-10 log-probabilities of the whole text with its end; a null
    text is empty. Rows are scored one by one, repeated rows alike; an input
    column named like an added one is replaced. A model of no text knows no word.
    """
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
    kept = [c for c in docs.columns if c != text_col and c not in added]

    def flush(held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        count, base, score = model.log10(np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held]))
        at = 0
        for batch, rows, before, _ in held:
            part, n = slice(at, at + len(before)), batch.num_rows
            at += len(before)
            n_tokens = np.bincount(rows, minlength=n)
            total = np.bincount(rows, score[part], n)
            values = [
                n_tokens, np.bincount(rows, count[part] > 0, n).astype(np.int64), np.full(n, model.train_tokens),
                np.bincount(rows, base[part], n), total, 10 ** np.minimum(-total / n_tokens, 300),
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *map(pa.array, values)], [*kept, *added])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, text_col):
            held.append((batch.select(kept), *tokens(batch.column(text_col))))
            size += len(held[-1][2])
            if size >= SCORE_TOKENS:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name in kept)
    wanted = docs.select(*kept, text_col)
    return wanted.mapInArrow(
        score, kinds + "n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    )


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the checksum of the id as text leaves 1 modulo 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))
