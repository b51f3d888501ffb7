"""Toxicity by two Kneser-Ney models, one of each class, that back off to shared counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.llm.words import PUNCTUATION, mix, run_hashes, slices, split_words, word_hashes
from lettermill.session import staged

ROWS_PER_CLASS = 4_000  # labelled documents of a class that are learned from, at most about so many
CALIBRATION_PARTS = 4  # one part in so many of them fits the scale of the score
DISCOUNT = 3.0  # an expression seen up to so often in a class says nothing by itself
BACKOFF = 100_000.0  # weight, in counts, of the model of single words behind every word before; a class gets it by its size
NEUTRAL_WORDS = 30  # added to the length, so that one odd word does not decide over a short text
TAIL_PART = 20  # the mean of one in so many ratios of a text, the highest ones, is looked at beside that of all
NEUTRAL_TAIL = 3  # added to the length of that tail
START = np.uint64(0)  # what stands before the first word


def bigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash of the word before, and hash of the word, for every word."""
    words = split_words(column, lower=True, separators=PUNCTUATION)
    after = word_hashes(words)
    rows = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[words.first[:-1][np.diff(words.first) > 0]] = START
    return rows, before, after


def pair_key(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + after)


def _counts(labelled: DataFrame) -> DataFrame:
    """``(v, w, toxic, ordinary)``: in how many documents of either class w follows v."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            rows, before, after = bigrams(batch.column("t"))
            keys = pair_key(before, after)
            order = np.lexsort((rows, keys))
            once = np.ones(len(order), bool)  # a long or repetitive document has no more weight than others
            once[1:] = (keys[order][1:] != keys[order][:-1]) | (rows[order][1:] != rows[order][:-1])
            rows, before, after, keys = (x[order[once]] for x in (rows, before, after, keys))
            toxic = batch.column("toxic").to_numpy()[rows] if len(rows) else np.zeros(0, np.int64)
            keys, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
            n_toxic = np.bincount(inverse, toxic, len(keys)).astype(np.int64)
            n_all = np.bincount(inverse, minlength=len(keys))
            arrays = [before[at].view(np.int64), after[at].view(np.int64), n_toxic, n_all - n_toxic]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], ["v", "w", "toxic", "ordinary"])

    counted = labelled.select("t", F.col("toxic").cast("long").alias("toxic"))
    return (
        counted.mapInArrow(count, "v long, w long, toxic long, ordinary long")
        .groupBy("v", "w").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    )


@dataclass(frozen=True)
class ToxicityModel:
    """Log ratios of both class models as sorted arrays, and the scale of the score.

    Its size follows ``ROWS_PER_CLASS``, not the corpus.
    """

    words: np.ndarray
    word_ratio: np.ndarray  # log p(word | toxic) - log p(word | ordinary)
    context_ratio: np.ndarray  # the same for the weights of the backoff behind a word
    pairs: np.ndarray
    pair_ratio: np.ndarray
    unknown_ratio: float
    slope: tuple[float, float, float]
    intercept: float

    def ratios(self, column: pa.Array) -> np.ndarray:
        """For every text: log-likelihood ratio per word, that of its most toxic words, and of the most toxic one; 0 without words."""
        n = len(column)
        rows, before, after = bigrams(column)
        if not len(rows) or not len(self.words):
            return np.zeros((n, 3))
        at, known = _find(self.words, after)
        ratio = np.where(known, self.word_ratio[at], self.unknown_ratio)
        at, known = _find(self.words, before)
        ratio = ratio + np.where(known, self.context_ratio[at], 0.0)
        if len(self.pairs):
            at, known = _find(self.pairs, pair_key(before, after))
            ratio = np.where(known, self.pair_ratio[at], ratio)
        length = np.bincount(rows, minlength=n)
        highest = ratio[np.lexsort((-ratio, rows))]  # rows stay in their order
        place = np.arange(len(rows)) - (np.cumsum(length) - length)[rows]
        tail = -(-length // TAIL_PART)
        upper = np.bincount(rows, np.where(place < tail[rows], highest, 0.0), n)
        most = np.bincount(rows, np.where(place == 0, highest, 0.0), n)
        return np.column_stack((np.bincount(rows, ratio, n) / (NEUTRAL_WORDS + length), upper / (NEUTRAL_TAIL + tail), most))

    def scores(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.ratios(column) @ np.array(self.slope) + self.intercept, -500, 500)))


def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_CLASS) -> tuple[DataFrame, float]:
    """Texts ``(t, toxic, fold)`` of about ``rows`` documents of either class at most, and the share of toxic labels.

    Chosen by a hash of the id. Copies and near copies, told by their smallest
    shingle hash, count once with the mark of most of them, else their own
    phrases would look like those of a class. Ids with a null label count as unlabelled;
    several labels of one id count as toxic if one of them is.
    """
    marks = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000))
    keep = F.lit(False)
    rows = rows if len(n) == 2 else 0
    for mark, count in n.items():
        keep = keep | ((F.col("toxic") == mark) & (place < -(-1_000_000 * rows // count)))
    chosen = marks.filter(keep).select(F.col("doc_id").alias("i"), "toxic")
    fold = F.pmod(F.xxhash64("i", F.lit(12)), F.lit(CALIBRATION_PARTS))
    texts = docs.select(F.col("doc_id").alias("i"), F.col("text").alias("t"))
    sample = staged(texts.join(F.broadcast(chosen), "i").select("t", "toxic", fold.alias("fold")), "labelled")  # about 2 * rows ids
    once = _with_sketch(sample).groupBy("sketch").agg(
        F.min("t").alias("t"), F.round(F.avg("toxic")).cast("int").alias("toxic"), F.min("fold").alias("fold")
    )
    return once, n.get(1, 0) / sum(n.values()) if n else 0.5


def _with_sketch(sample: DataFrame) -> DataFrame:
    """Adds the smallest hash of three words in a row (of the whole text where it is shorter)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            words = split_words(batch.column("t"), lower=True, separators=PUNCTUATION)
            hashes, low, high = word_hashes(words), words.first[:-1], words.first[1:]
            least = np.zeros(batch.num_rows, np.uint64)
            for row, (a, b) in enumerate(zip(low, high)):
                starts = np.arange(a, max(a, b - 3) + (b > a))
                if len(starts):
                    least[row] = run_hashes(hashes, starts, np.minimum(starts + 3, b)).min()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(least.view(np.int64))], [*batch.schema.names, "sketch"]
            )

    return sample.mapInArrow(sketch, "t string, toxic int, fold long, sketch long")


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_CLASS) -> ToxicityModel:
    """Learn from the documents that ``labels (doc_id, toxic)`` marks; ``rows`` bounds those of each class.

    Bigram models of both classes with absolute discount; unigrams of the class
    below them; below these counts of rare expressions shared by both classes, so
    that such an expression is as likely in either. No ratio is cut. A text is told by
    the mean of its ratios, by the mean of the highest ones and by the highest, for most words of a
    toxic text are ordinary. Their weights are fitted on a part of the sample that the
    counts do not hold. Without labels of both classes every
    text gets the share of toxic labels as score (one half if there is none).
    """
    sample, share = labelled_sample(docs, labels, rows)
    none = np.zeros(0, np.uint64)
    if sample.isEmpty():
        share = np.clip(share, 1e-3, 1 - 1e-3)
        return ToxicityModel(none, none, none, none, none, 0.0, (0.0, 0.0, 0.0), float(np.log(share / (1 - share))))
    pairs = staged(_counts(sample.filter("fold > 0")), "pairs")
    model = _ratios(pairs)
    return _calibrated(model, sample.filter("fold = 0"), share)


def _ratios(pairs: DataFrame) -> ToxicityModel:
    """Each model below gets what the discount takes from the one above, so marginal counts are kept."""
    classes = ("toxic", "ordinary")
    cut = lambda n: F.greatest(n - DISCOUNT, F.lit(0.0))
    freed = lambda n: F.least(n, F.lit(DISCOUNT))
    words = staged(
        pairs.groupBy(F.col("w").alias("h")).agg(
            *[F.sum(freed(F.col(c))).alias(c) for c in classes], *[F.sum(c).alias(f"n_{c}") for c in classes]
        ), "words"
    )
    sums = words.agg(
        *[F.sum(c).alias(c) for c in classes], *[F.sum(freed(F.col(c))).alias(f"freed_{c}") for c in classes],
        *[F.sum(f"n_{c}").alias(f"n_{c}") for c in classes],
    ).first()
    if not sums["toxic"] or not sums["ordinary"]:
        none = np.zeros(0, np.uint64)
        return ToxicityModel(none, none, none, none, none, 0.0, (0.0, 0.0, 0.0), 0.0)
    backoff = {c: sums[f"freed_{c}"] / sums[c] for c in classes}
    rest = sums["freed_toxic"] + sums["freed_ordinary"] + 1  # one for words never seen
    shared = (freed(F.col("toxic")) + freed(F.col("ordinary"))) / rest
    one = words.select("h", *[(cut(F.col(c)) / sums[c] + backoff[c] * shared).alias(f"p_{c}") for c in classes])
    weight = {c: BACKOFF * sums[f"n_{c}"] * 2 / (sums["n_toxic"] + sums["n_ordinary"]) for c in classes}
    contexts = pairs.groupBy("v").agg(
        *[F.sum(c).alias(f"n_{c}") for c in classes], *[F.sum(freed(F.col(c))).alias(f"f_{c}") for c in classes]
    ).select("v", *[f"n_{c}" for c in classes], *[
        ((F.col(f"f_{c}") + weight[c]) / (F.col(f"n_{c}") + weight[c])).alias(f"l_{c}") for c in classes
    ])
    common = pairs.filter((F.col("toxic") > DISCOUNT) | (F.col("ordinary") > DISCOUNT))  # the others follow from words
    two = common.join(one, F.col("w") == F.col("h")).join(contexts, "v")
    p = {c: cut(F.col(c)) / (F.col(f"n_{c}") + weight[c]) + F.col(f"l_{c}") * F.col(f"p_{c}") for c in classes}

    def ratio(toxic: Column, ordinary: Column) -> Column:
        return F.log(toxic / ordinary).cast("float")

    pair_rows = two.select("v", "w", ratio(p["toxic"], p["ordinary"]).alias("r")).toArrow()
    word_rows = one.join(contexts, F.col("h") == F.col("v"), "full").select(  # the place before the first word is no word
        F.coalesce("h", "v").alias("h"),
        F.coalesce(ratio(F.col("p_toxic"), F.col("p_ordinary")), F.lit(0.0).cast("float")).alias("r"),
        F.coalesce(ratio(F.col("l_toxic"), F.col("l_ordinary")), F.lit(0.0).cast("float")).alias("c"),
    ).toArrow()
    unsigned = lambda table, name: table.column(name).to_numpy().view(np.uint64)
    keys, h = pair_key(unsigned(pair_rows, "v"), unsigned(pair_rows, "w")), unsigned(word_rows, "h")
    by_key, by_hash = np.argsort(keys), np.argsort(h)
    return ToxicityModel(
        h[by_hash], word_rows.column("r").to_numpy()[by_hash], word_rows.column("c").to_numpy()[by_hash],
        keys[by_key], pair_rows.column("r").to_numpy()[by_key], 0.0, (1.0, 0.0, 0.0), 0.0,
    )


def _calibrated(model: ToxicityModel, sample: DataFrame, share: float) -> ToxicityModel:
    """Slopes and intercept by logistic regression, moved from the sample's share of toxic texts to the true one."""
    rows = _with_ratios(sample.select("toxic", "t"), model, "toxic int").toArrow()
    x = np.column_stack([rows.column(c).to_numpy() for c in ("mean", "upper", "most")]).astype(float)
    y = rows.column("toxic").to_numpy().astype(float)
    centre = x.mean(axis=0) if len(x) else np.zeros(3)
    scale = x.std(axis=0) if len(x) else np.ones(3)
    scale[scale == 0] = 1.0
    design = np.column_stack(((x - centre) / scale, np.ones(len(x))))
    beta = np.zeros(4)
    penalty = np.diag([1e-2, 1e-2, 1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian, design.T @ (y - p) - penalty @ beta)
        beta += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    moved = 0.0
    if len(y) and 0 < y.mean() < 1:
        moved = np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    slope = beta[:3] / scale
    intercept = beta[3] + moved - slope @ centre
    return ToxicityModel(**{**model.__dict__, "slope": tuple(map(float, slope)), "intercept": float(intercept)})


def _with_ratios(docs: DataFrame, model: ToxicityModel, kept: str) -> DataFrame:
    """The first column of ``docs``, named and typed as ``kept``, and the three ratios of its text ``t``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = kept.split()[0]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            ratios = shared.value.ratios(batch.column("t"))
            arrays = [batch.column(0), *[pa.array(np.ascontiguousarray(x)) for x in ratios.T]]
            yield pa.RecordBatch.from_arrays(arrays, [name, "mean", "upper", "most"])

    return docs.mapInArrow(score, f"{kept}, mean double, upper double, most double")


def with_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` and ``score`` (0 to 1) and ``predicted`` (1 where the score is at least one half).

    A null text is scored like an empty one. Repeated rows are scored alike; no
    other column takes part, and one named like an added column is replaced.
    """
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            scores = shared.value.scores(batch.column(text_col))
            arrays = [batch.column(c) for c in names] + [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "score", "predicted"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in names)
    return docs.select(*names).mapInArrow(score, f"{kinds}, score double, predicted int")


def held_out(id_col: str = "doc_id", remainder: int = 0) -> Column:
    """Whether the checksum of the id as text leaves ``remainder`` modulo 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == remainder, F.lit(False))
