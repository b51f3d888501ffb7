"""Ranked lexical search: an index of document shards, evaluated by hybrid TAAT-DAAT.

The index is a table with one row per shard of documents: its terms in hash
order with their postings. A query first works term at a time: the short
posting lists are added up into accumulators. These are then one more iterator
with a known upper bound, beside the long lists, in a document-at-a-time pass:
iterators whose bounds together cannot lift a document into the result are
never walked, only looked into for the documents that the others bring up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lettermill.llm.words import PUNCTUATION, slices, split_words, word_hashes
from lettermill.session import staged

TOP = 10
SHARD_BYTES = 4 << 20  # text of a shard, about; a longer document is a shard of its own
SHORT = 16  # a list is short if it holds at most one in so many documents of its shard
STEP = 1024  # documents of a shard that are scored at a time
BLOCK_TERMS = 500_000  # terms of the items that are searched in one pass, about
MERGE_SLOTS = 64

_INDEX = (
    "n_docs long, n_terms long, ids binary, no_id binary, sizes binary, terms binary, offsets binary, places binary, counts binary"
)


def _packed(values: np.ndarray) -> bytes:
    """Unsigned numbers in the narrowest type that holds the largest, which the first byte names."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.dtype(f"u{data[0]}"), offset=1)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "t", SHARD_BYTES):
        words = split_words(batch.column("t"), lower=True, separators=PUNCTUATION)
        sizes = np.diff(words.first)
        used = np.flatnonzero(sizes)
        if not len(used):
            continue
        hashes = word_hashes(words)
        order = np.argsort(hashes, kind="stable")
        term, doc = hashes[order], np.repeat(np.arange(len(used)), sizes[used])[order]
        new_term = np.ones(len(term), bool)
        new_term[1:] = term[1:] != term[:-1]
        new_posting = new_term.copy()
        new_posting[1:] |= doc[1:] != doc[:-1]
        postings = np.flatnonzero(new_posting)
        ids = batch.column("i").take(pa.array(used))
        row = {
            "n_docs": len(used),
            "n_terms": len(term),
            "ids": ids.fill_null(0).to_numpy().tobytes(),
            "no_id": np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes(),
            "sizes": _packed(sizes[used]),
            "terms": term[new_term].tobytes(),
            "offsets": _packed(np.append(np.flatnonzero(new_term[postings]), len(postings))),
            "places": _packed(doc[postings]),
            "counts": _packed(np.diff(np.append(postings, len(term)))),
        }
        yield pa.RecordBatch.from_pydict({k: [v] for k, v in row.items()})


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index table of all documents that have a term; one row a shard, made without a shuffle.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, with
    only A-Z lower-cased, and are kept as 64-bit hashes. Null texts have none.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    return staged(narrow.mapInArrow(_shards, _INDEX), "lexical-index")


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``(item, term)``; rows of one id are one item with the terms of all."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            words = split_words(batch.column("t"), lower=True, separators=PUNCTUATION)
            rows = np.repeat(np.arange(batch.num_rows), np.diff(words.first))
            ids = batch.column("i").take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([ids, pa.array(word_hashes(words).view(np.int64))], ["item", "term"])

    narrow = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    return narrow.mapInArrow(terms, "item long, term long").distinct()


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, and all their terms with repeats."""

    n_docs: int
    n_terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1)))

    def norms(self, sizes: np.ndarray) -> np.ndarray:
        """Length part of a document's score, from its number of terms."""
        if 90 * int(sizes.max(initial=0)) * self.n_docs < 1 << 63:
            return 10 + 90 * sizes.astype(np.int64) * self.n_docs // self.n_terms
        return np.array([10 + 90 * int(n) * self.n_docs // self.n_terms for n in sizes], np.int64)


@dataclass(frozen=True)
class Items:
    """Items of one block: their ids, the block's terms in order, weights of these, and terms of each item by number."""

    ids: list[int | None]
    terms: np.ndarray
    weights: np.ndarray
    of_item: list[np.ndarray]


class Best:
    """The ``top`` highest (score, lowest id) of an item seen so far; ids that are null come last."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids, self.no_id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def floor(self) -> int:
        """A document needs this score at least to come in."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        scores, ids, no_id = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.no_id, no_id)))
        order = np.lexsort((ids, no_id, -scores))[: self.top]
        self.scores, self.ids, self.no_id = scores[order], ids[order], no_id[order]


class Shard:
    """Postings of a block's terms in one shard, with their scores."""

    def __init__(self, row: dict, items: Items, corpus: Corpus):
        self.n = row["n_docs"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.no_id = np.unpackbits(np.frombuffer(row["no_id"], np.uint8))[: self.n].astype(bool)
        held = np.frombuffer(row["terms"], np.uint64)
        at = np.minimum(np.searchsorted(held, items.terms), len(held) - 1)
        present = np.flatnonzero(held[at] == items.terms)
        offsets = _unpacked(row["offsets"]).astype(np.int64)
        first, size = offsets[at[present]], offsets[at[present] + 1] - offsets[at[present]]
        self.begin = np.append(0, np.cumsum(size))
        spread = np.repeat(first - self.begin[:-1], size) + np.arange(self.begin[-1])
        self.places = _unpacked(row["places"])[spread].astype(np.int64)
        counts = _unpacked(row["counts"])[spread].astype(np.int64)
        norm = corpus.norms(_unpacked(row["sizes"]))[self.places]
        self.scores = np.repeat(items.weights[present], size) * (1_000_000_000 * counts // (1000 * counts + 8 * norm))
        self.bounds = np.maximum.reduceat(self.scores, self.begin[:-1]) if len(present) else self.scores
        self.list_of = np.full(len(items.terms), -1)
        self.list_of[present] = np.arange(len(present))

    def postings(self, number: int) -> tuple[np.ndarray, np.ndarray, int]:
        part = slice(self.begin[number], self.begin[number + 1])
        return self.places[part], self.scores[part], int(self.bounds[number])

    def accumulators(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Term at a time: the summed scores of some lists as one list."""
        sums = np.zeros(self.n, np.int64)
        for number in numbers:
            places, scores, _ = self.postings(number)
            sums[places] += scores
        places = np.flatnonzero(sums)
        return places, sums[places], int(sums.max(initial=0))

    def search(self, terms: np.ndarray, best: Best) -> None:
        """Document at a time over the accumulators and the long lists; ``best`` takes what comes in."""
        numbers = self.list_of[terms]
        numbers = numbers[numbers >= 0]
        numbers = numbers[self.bounds[numbers] > 0]
        short = np.diff(self.begin)[numbers] * SHORT <= self.n
        lists = [self.postings(number) for number in numbers[~short]]
        if short.any():
            lists.append(self.accumulators(numbers[short]))
        lists.sort(key=lambda x: x[2])
        upto = np.cumsum([bound for _, _, bound in lists], dtype=np.int64)  # what the lists up to here can add at most
        for low in range(0, self.n, STEP):
            high = min(self.n, low + STEP)
            floor = best.floor
            leading = int(np.searchsorted(upto, floor))  # lists before it cannot reach the floor together
            if leading == len(lists):
                return
            sums = np.zeros(high - low, np.int64)
            for places, scores, _ in lists[leading:]:
                a, b = np.searchsorted(places, (low, high))
                sums[places[a:b] - low] += scores[a:b]
            found = np.flatnonzero(sums)
            for number in range(leading - 1, -1, -1):
                found = found[sums[found] + upto[number] >= floor]
                if not len(found):
                    break
                places, scores, _ = lists[number]
                at = np.minimum(np.searchsorted(places, found + low), len(places) - 1)
                hit = places[at] == found + low
                sums[found[hit]] += scores[at[hit]]
            found = found[sums[found] >= floor]
            if len(found):
                best.add(sums[found], self.ids[found + low], self.no_id[found + low])


def document_counts(index: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """Documents that hold each of ``terms`` (ascending); as many rows as terms at most come back."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                held, offsets = np.frombuffer(row["terms"], np.uint64), _unpacked(row["offsets"]).astype(np.int64)
                at = np.minimum(np.searchsorted(held, shared.value), len(held) - 1)
                total += np.where(held[at] == shared.value, offsets[at + 1] - offsets[at], 0)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(shared.value[found].view(np.int64)), pa.array(total[found])], ["term", "n"])

    counted = index.select("terms", "offsets").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {row["term"]: row["n"] for row in counted.collect()}


def _block(index: DataFrame, rows: pa.Table, corpus: Corpus) -> Items:
    item, term = rows.column("item"), rows.column("term").to_numpy().view(np.uint64)
    terms, number = np.unique(term, return_inverse=True)
    df = document_counts(index, terms)
    weights = np.array([corpus.weight(df.get(t, 0)) for t in terms.view(np.int64).tolist()], np.int64)
    of_item: dict[int | None, list[int]] = {}
    for i, t in zip(item.to_pylist(), number.tolist()):
        of_item.setdefault(i, []).append(t)
    return Items(list(of_item), terms, weights, [np.array(ts) for ts in of_item.values()])


def _search_block(index: DataFrame, items: Items, corpus: Corpus, top: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(items)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        best = [Best(top) for _ in block.ids]
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, block, corpus)
                for terms, found in zip(block.of_item, best):
                    shard.search(terms, found)
        size = [len(b.scores) for b in best]
        if sum(size):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, n in zip(block.ids, size) for _ in range(n)], pa.int64()),
                    pa.array(np.concatenate([b.ids for b in best]), mask=np.concatenate([b.no_id for b in best])),
                    pa.array(np.concatenate([b.scores for b in best])),
                ],
                ["item_id", "doc_id", "score"],
            )

    found = index.mapInArrow(search, "item_id long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # every task brings its best; slots keep the number that one task merges small
    slot = F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_SLOTS))
    partly = found.withColumn("slot", slot).withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "slot").orderBy(*order)))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    merged = partly.filter(F.col("rank") <= top).withColumn("rank", rank).filter(F.col("rank") <= top)
    return merged.select("item_id", "rank", "doc_id", "score")


def search(index: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` highest documents of every item, with a score above 0.

    Equal scores go by ascending ``doc_id``, null ids last. Items are searched
    in blocks of about ``BLOCK_TERMS`` terms, so what is broadcast does not grow
    with their number. Rows of one ``item_id`` (null too) are one item; items
    without a term have no rows. Repeated documents are each ranked.
    """
    terms = staged(item_terms(items, id_col, text_col), "item-terms")
    total = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    corpus = Corpus(total[0] or 0, total[1] or 0)
    schema = "item_id long, rank int, doc_id long, score long"
    result = index.sparkSession.createDataFrame([], schema)
    if not corpus.n_docs:
        return result
    blocks = max(1, -(-terms.count() // BLOCK_TERMS))
    numbered = terms.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    for block in range(blocks):
        rows = numbered.filter(F.col("block") == block).select("item", "term").toArrow()
        if rows.num_rows:
            found = staged(_search_block(index, _block(index, rows, corpus), corpus, top), "ranked")
            result = found if block == 0 else result.unionByName(found)
    return result


def rank_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """``search`` over all rows of ``docs`` for every row of ``items``. Other columns are not read.

    Null and empty texts have no terms: such documents are never found and count
    nowhere, such items have no rows. Empty tables give no rows.
    """
    return search(build_index(docs, id_col, text_col), items, top, item_col, text_col)
