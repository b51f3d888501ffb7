"""SentencePiece encoding and decoding by suffix-array matching of all pieces in a batch.

The new words of a batch are concatenated and their suffixes sorted. Every piece is
searched in the sorted suffixes, which gives all places where it occurs: the
edges of a lattice. Edges are sorted by position and relaxed. The models at
hand are of the merge type, for which a best path over piece scores would give
other ids; so an edge is relaxed when it joins two neighbouring symbols, the
best score first, the leftmost among equals.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.words import slices

MARK = "▁"  # stands for a space
MAX_PIECE = 16  # characters; suffixes are sorted by so many
FLUSH_CHARS = 400_000  # characters of new words that are matched together
KNOWN_WORDS = 200_000  # words whose ids a worker keeps; more are matched again
LONG_RUN = 64  # characters; longer runs of linked edges are relaxed one by one
UNKNOWN_TEXT = " ⁇ ".encode()


class Pieces:
    """Pieces of a merge-type model as arrays for matching and decoding."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(n)]
        ordinary = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        if max(len(names[i]) for i in ordinary) > MAX_PIECE or any(MARK in names[i].strip(MARK) or names[i].endswith(MARK) and names[i].strip(MARK) for i in ordinary):
            raise ValueError("pieces must have 16 characters at most, with spaces only in front")
        self.unknown = model.unk_id()
        chars = sorted({c for i in ordinary for c in names[i]})
        self.code = np.zeros(0x110000, np.uint16)  # 0: in no piece
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.char_id = np.full(0x110000, -1, np.int32)
        for i in ordinary:
            if len(names[i]) == 1:
                self.char_id[ord(names[i])] = i
        self.byte_id = np.zeros(256, np.int32)
        self.has_bytes = False
        for i in range(n):
            if model.is_byte(i):
                self.byte_id[int(names[i][1:-1], 16)] = i
                self.has_bytes = True
        self.edges = np.array([i for i in ordinary if len(names[i]) > 1], np.int64)
        self.length = np.array([len(names[i]) for i in self.edges], np.int64)
        scores = np.array([model.get_score(int(i)) for i in self.edges])
        self.rank = np.unique(-scores, return_inverse=True)[1]  # equal scores have equal ranks
        codes = np.zeros((len(self.edges), MAX_PIECE), np.uint64)
        for row, i in enumerate(self.edges.tolist()):
            codes[row, : len(names[i])] = self.code[[ord(c) for c in names[i]]]
        behind = codes.copy()  # the first string after all that begin with the piece
        behind[np.arange(len(codes)), self.length - 1] += np.uint64(1)
        self.low, self.high = _quads(codes), _quads(behind)
        joined = {c for i in self.edges.tolist() for c in names[i]}
        self.units = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n" if "\n" not in joined else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        texts = []
        for i in range(n):
            if model.is_byte(i):
                texts.append(bytes([int(names[i][1:-1], 16)]))
            elif model.is_control(i):
                texts.append(b"")
            else:
                texts.append(UNKNOWN_TEXT if i == self.unknown else names[i].replace(MARK, " ").encode())
        self.text_length = np.array([len(t) for t in texts])
        self.text_start = np.append(0, np.cumsum(self.text_length))
        self.text = np.frombuffer(b"".join(texts), np.uint8)

    def match(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All places of all pieces in ``code``: position and row of ``edges``, sorted by position."""
        n = len(code)
        padded = np.concatenate((code, np.zeros(MAX_PIECE, np.uint16))).astype(np.uint64)
        quad = padded[:-3] << np.uint64(48) | padded[1:-2] << np.uint64(32) | padded[2:-1] << np.uint64(16) | padded[3:]
        order, key = None, quad
        for reach in (4, 8, 16):  # ranks by ever longer beginnings of the suffixes
            order = np.argsort(key)
            rank = np.empty(len(key), np.uint64)
            rank[order] = np.cumsum(np.append(False, key[order][1:] != key[order][:-1])).astype(np.uint64)
            beyond = np.append(rank[reach:], np.zeros(min(reach, len(rank)), np.uint64))
            key = rank << np.uint64(32) | beyond
        suffixes = order[order < n]
        parts = [quad[np.minimum(suffixes + 4 * k, len(quad) - 1)] for k in range(4)]
        begin, end = _bisect(parts, self.low), _bisect(parts, self.high)
        size = np.maximum(end - begin, 0)
        piece = np.repeat(np.arange(len(size)), size)
        at = suffixes[np.arange(len(piece)) - np.repeat(np.cumsum(size) - size - begin, size)]
        by_place = np.argsort(at)
        return at[by_place], piece[by_place]

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit numbers. A word is what ``units`` finds in a text."""
        sizes = np.array([len(w) for w in words])
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        bounds = np.append(0, np.cumsum(sizes))
        spread = np.zeros(len(points) + len(words), np.int64)  # a gap behind every word
        place = np.arange(len(points)) + np.repeat(np.arange(len(words)), sizes)
        spread[place] = points
        code = np.zeros(len(spread), np.uint16)
        code[place] = self.code[points]
        starts, piece = self.match(code)
        symbol, kept = relax(len(spread), starts, starts + self.length[piece], self.rank[piece], self.edges[piece])
        char = np.zeros(len(spread), bool)
        char[place] = True
        at = np.flatnonzero(kept & char)
        single = symbol[at] < 0
        ids = np.where(single, self.char_id[spread[at]], symbol[at])
        word = np.searchsorted(bounds[1:] + np.arange(1, len(words) + 1), at, "right")
        missing = np.flatnonzero(ids < 0)
        if len(missing):  # characters without a piece: their bytes, or the unknown id
            spelled = [
                [int(self.byte_id[b]) for b in chr(int(spread[at[m]])).encode()] if self.has_bytes else [self.unknown] for m in missing
            ]
            count = np.ones(len(ids), np.int64)
            count[missing] = [len(s) for s in spelled]
            ids, word = np.repeat(ids, count), np.repeat(word, count)
            ids[ids < 0] = [b for s in spelled for b in s]
        cuts = np.searchsorted(word, np.arange(len(words) + 1)) * 4
        data = ids.astype("<u4").tobytes()
        return [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of ids; the space that every text begins with is taken off."""
        size = self.text_length[ids]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - self.text_start[ids], size)
        return self.text[at].tobytes().removeprefix(b" ")


def _quads(codes: np.ndarray) -> list[np.ndarray]:
    c = codes.astype(np.uint64)
    return [c[:, k] << np.uint64(48) | c[:, k + 1] << np.uint64(32) | c[:, k + 2] << np.uint64(16) | c[:, k + 3] for k in (0, 4, 8, 12)]


def _bisect(parts: list[np.ndarray], wanted: list[np.ndarray]) -> np.ndarray:
    """First sorted suffix that is not below each wanted one, compared part by part."""
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(parts[0]))
    while (open_ := low < high).any():
        mid = np.minimum((low + high) // 2, len(parts[0]) - 1)
        below, same = np.zeros(len(low), bool), np.ones(len(low), bool)
        for have, want in zip(parts, wanted):
            value = have[mid]
            below |= same & (value < want)
            same &= value == want
        low = np.where(open_ & below, mid + 1, low)
        high = np.where(open_ & ~below, mid, high)
    return low


def relax(n: int, start: np.ndarray, end: np.ndarray, rank: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value of the symbol at each position (-1: a single character), and which positions begin a symbol.

    Edges come sorted by position. Runs of positions that no edge leaves are
    independent; in each, one edge is relaxed a round: of those that join two
    neighbouring symbols the one of the best rank, then the leftmost.
    """
    symbol = np.full(n, -1, np.int64)
    begins = np.ones(n + 1, bool)
    behind = np.arange(1, n + 2)  # where the symbol at a position ends
    crossed = np.cumsum(np.bincount(start + 1, minlength=n + 2) - np.bincount(end, minlength=n + 2))
    run = np.cumsum(crossed[:n] == 0)
    long_runs = np.bincount(run) > LONG_RUN
    is_long = long_runs[run[start]] if len(start) else np.zeros(0, bool)
    for r in np.unique(run[start[is_long]]):
        at = np.flatnonzero(run[start] == r) if long_runs.sum() < 64 else np.arange(*np.searchsorted(run[start], (r, r + 1)))
        _relax_one(symbol, begins, behind, start[at].tolist(), end[at].tolist(), rank[at].tolist(), value[at].tolist())
    start, end, rank, value = (x[~is_long] for x in (start, end, rank, value))
    priority = rank.astype(np.int64) << 32 | start
    while len(start):
        alive = begins[start] & begins[end] & (behind[start] < end)
        start, end, value, priority = start[alive], end[alive], value[alive], priority[alive]
        joins = np.flatnonzero(behind[behind[start]] == end)
        if not len(joins):
            break
        runs = run[start[joins]]
        heads = np.flatnonzero(np.append(True, runs[1:] != runs[:-1]))
        best = np.minimum.reduceat(priority[joins], heads)
        chosen = joins[priority[joins] == np.repeat(best, np.diff(np.append(heads, len(joins))))]
        s, e = start[chosen], end[chosen]
        begins[behind[s]] = False
        behind[s], symbol[s] = e, value[chosen]
        active = np.zeros(run[-1] + 1, bool)
        active[runs[heads]] = True
        going = active[run[start]]
        start, end, value, priority = start[going], end[going], value[going], priority[going]
    return symbol, begins[:n]


def _relax_one(symbol, begins, behind, start, end, rank, value) -> None:
    """The same for one long run, with a queue of the edges that join neighbours."""
    edges = {(s, e): (r, v) for s, e, r, v in zip(start, end, rank, value)}
    low, high = min(start), max(end)
    after = {p: p + 1 for p in range(low, high)}
    before = {p + 1: p for p in range(low, high)}
    queue: list[tuple[int, int, int]] = []

    def offer(s: int) -> None:
        e = after.get(after[s])
        if e is not None and (s, e) in edges:
            heapq.heappush(queue, (edges[s, e][0], s, e))

    for s in range(low, high):
        offer(s)
    while queue:
        _, s, e = heapq.heappop(queue)
        if s not in after or after.get(after[s]) != e:
            continue
        middle = after.pop(s)
        after.pop(middle)
        after[s], before[e] = e, s
        before.pop(middle)
        begins[middle], behind[s], symbol[s] = False, e, edges[s, e][1]
        if s in before:
            offer(before[s])
        if e in after:
            offer(s)


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    """One per worker process."""
    return Pieces(path)


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One per worker process, so that tasks share the words it knows."""
    return Encoder(pieces_of(path))


class Encoder:
    """Ids of texts; keeps the ids of words it has seen."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        words = [self.pieces.units.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        used = set(chain.from_iterable(words))
        if len(self.known) > KNOWN_WORDS:
            self.known = {w: self.known[w] for w in used & self.known.keys()}
        held, size = [], 0
        for word in used.difference(self.known):
            held.append(word)
            size += len(word)
            if size >= FLUSH_CHARS:
                self._learn(held)
                held, size = [], 0
        if held:
            self._learn(held)
        return [np.frombuffer(b"".join(map(self.known.__getitem__, ws)), "<u4") for ws in words]

    def _learn(self, words: list[str]) -> None:
        self.known.update(zip(words, self.pieces.encode(words)))


def encode_documents(docs: DataFrame, model_path: str, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_ids, n_byte_ids, ids_crc32, decoded_sha256, lossless[, ids])`` of every row.

    ``ids`` are little-endian 32-bit numbers. Decoding gives the text back
    (``lossless``) but for the character U+2581, which comes back as a space. A
    null text is empty and has no ids. Repeated rows and rows without an id
    stay; other columns are not read; an empty table gives no rows.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model_path)
        encoder = encoder_of(model_path)
        is_byte = np.zeros(len(pieces.text_length), bool)
        is_byte[pieces.byte_id] = pieces.has_bytes
        for batch in slices(batches, "t"):
            texts = [t or "" for t in batch.column("t").to_pylist()]
            encoded = encoder.encode(texts)
            decoded = [pieces.decode(ids) for ids in encoded]
            columns = [
                pa.array([len(x) for x in encoded], pa.int64()), pa.array([int(is_byte[x].sum()) for x in encoded], pa.int64()),
                pa.array([zlib.crc32(x.tobytes()) for x in encoded], pa.int64()),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
                pa.array([d == t.replace(MARK, " ").encode() for d, t in zip(decoded, texts)]),
            ]
            names = ["doc_id", "n_ids", "n_byte_ids", "ids_crc32", "decoded_sha256", "lossless"]
            if with_ids:
                columns.append(pa.array([x.tobytes() for x in encoded], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([batch.column("i"), *columns], names)

    schema = "doc_id long, n_ids long, n_byte_ids long, ids_crc32 long, decoded_sha256 string, lossless boolean"
    narrow = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    return narrow.mapInArrow(encode, schema + ", ids binary" * with_ids)


def decode_documents(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, text)`` of rows with ids as ``encode_documents`` gives them; null ids give an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model_path)
        for batch in slices(batches, "t"):
            texts = [pieces.decode(np.frombuffer(b or b"", "<u4")).decode("utf-8", "replace") for b in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(texts, pa.string())], ["doc_id", "text"])

    narrow = encoded.select(F.col(id_col).cast("long").alias("i"), F.col(ids_col).alias("t"))
    return narrow.mapInArrow(decode, "doc_id long, text string")
