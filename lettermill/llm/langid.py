"""Language of pages and documents: text, declared language, address suffix and host, fused by Bayes' rule."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.llm.words import PUNCTUATION, slices, text_bytes
from lettermill.session import staged

ROWS_PER_LANGUAGE = 2_000  # labelled documents of a language that are learned from, about
MAX_LANGUAGES = 64
BUCKET_BITS = 16  # a model row has so many log-probabilities
TEMPER = 0.1  # windows of four bytes overlap, so each is worth a part of an independent observation
PSEUDO_PAGES = 5.0  # weight of the wider group in every smoothed count
UNKNOWN = "und"
MIN_POSTERIOR = 0.3  # below it, a document is in no language of the model

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[PUNCTUATION] = 32
_FOLD[48:58] = 32
_HIDDEN = re.compile(rb"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = re.compile(rb"<[a-zA-Z/!?][^<>]*>")


def html_text(page: bytes) -> bytes:
    """Text of a page: no markup, scripts, styles or comments; entities resolved."""
    text = _TAG.sub(b" ", _HIDDEN.sub(b" ", page))
    return html.unescape(text.decode("utf-8", "replace")).encode() if b"&" in text else text


def window_buckets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of a four-byte window for every letter: two bytes before it, it, and the next one.

    Other characters are spaces, and so is what lies beyond the ends of a text.
    """
    gap = 3  # spaces between texts
    n = len(bounds) - 1
    folded = np.full(len(data) + gap * n + gap, 32, np.uint32)
    place = np.arange(len(data)) + gap * np.repeat(np.arange(1, n + 1), np.diff(bounds))
    folded[place] = _FOLD[data]
    code = folded[:-3] | folded[1:-2] << np.uint32(8) | folded[2:-1] << np.uint32(16) | folded[3:] << np.uint32(24)
    letters = np.flatnonzero(folded != 32)
    rows = np.searchsorted(bounds[1:] + gap * np.arange(1, n + 1), letters, "right")
    return rows, ((code[letters - 2] * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


@dataclass(frozen=True)
class TextModel:
    """Log-probabilities of window buckets, one row a language; size fixed by the number of languages."""

    languages: list[str]
    table: np.ndarray

    def evidence(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Letters, and tempered log-likelihoods (rows x languages) above the mean of the languages."""
        n = len(bounds) - 1
        rows, buckets = window_buckets(data, bounds)
        sums = np.stack([np.bincount(rows, line[buckets], n) for line in self.table], axis=1)
        return np.bincount(rows, minlength=n), TEMPER * (sums - sums.mean(axis=1, keepdims=True))


def fit_text_model(docs: DataFrame, rows: int = ROWS_PER_LANGUAGE, text_col: str = "text", lang_col: str = "lang") -> TextModel:
    """Learn from about ``rows`` labelled documents of each language, chosen by a hash of the text.

    Null texts and labels are left out. Of more than ``MAX_LANGUAGES`` languages,
    which bounds the model, those with the most texts are learned. One language is all
    that is found then; without any, every row is ``und``.
    """
    marked = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = marked.groupBy(lang_col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), lang_col).limit(MAX_LANGUAGES).collect()
    if not counts:
        return TextModel([UNKNOWN], np.zeros((1, 1 << BUCKET_BITS), np.float32))
    languages = sorted(r[0] for r in counts)
    marked = marked.filter(F.col(lang_col).isin(*languages))
    share = {r[0]: min(1.0, rows / r["n"]) for r in counts}
    number = F.coalesce(*[F.when(F.col(lang_col) == name, F.lit(i)) for i, name in enumerate(languages)])
    limit = F.coalesce(*[F.when(F.col(lang_col) == name, F.lit(int(1e6 * share[name]) + 1)) for name in languages])
    chosen = marked.filter(F.pmod(F.xxhash64(text_col, F.lit(3)), F.lit(1_000_000)) < limit)
    n, width = len(languages), 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * width, np.int64)
        for batch in slices(batches, "t"):
            rows_, buckets = window_buckets(*text_bytes(batch.column("t")))
            lang = batch.column("l").to_numpy()
            if len(rows_):
                total += np.bincount(lang[rows_] * width + buckets, minlength=n * width)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    counted = chosen.select(F.col(text_col).alias("t"), number.cast("long").alias("l")).mapInArrow(count, "at long, n long")
    cells = counted.groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # languages x buckets at most
    table = np.zeros(n * width)
    table[cells.column("at").to_numpy()] = cells.column("n").to_numpy()
    table = table.reshape(n, width)
    # a bucket that a language lacks is as likely as a tenth of its share in all languages
    shared = (table.sum(axis=0) + 0.1) / (table.sum() + 0.1 * width)
    smoothed = table + 0.1 * width * shared
    return TextModel(languages, np.log(smoothed / smoothed.sum(axis=1, keepdims=True)).astype(np.float32))


def page_evidence(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """What a page says: ``(id, host, domain, suffix, declared, n_letters, logits, p)``; ``p`` is the text's own posterior."""
    host = F.lower(F.regexp_extract(F.col(url_col), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    head = F.regexp_extract(F.col(html_col), r"(?i)<html\b(?:(?!<html\b)[^>])*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    return evidence(
        pages, model, F.col(id_col), F.col(html_col), F.nullif(host, F.lit("")), F.nullif(F.lower(head), F.lit("")), markup=True
    )


def evidence(
    df: DataFrame, model: TextModel, key: Column, text: Column, host: Column, declared: Column, markup: bool = False
) -> DataFrame:
    """Evidence table of any rows; ``host`` and ``declared`` may be null. Written once, without the texts."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    names = ("id", "host", "declared")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            column = batch.column("t")
            if markup:
                column = pa.array([html_text(t or b"") for t in column.cast(pa.binary()).to_pylist()], pa.large_binary())
            n, logits = shared.value.evidence(*text_bytes(column))
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            width = pa.array(np.arange(0, p.size + 1, p.shape[1]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(width, pa.array(x.ravel())) for x in (logits, p)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(n), *lists], [*names, "n_letters", "logits", "p"]
            )

    wide = df.select(key.cast("long").alias("id"), host.alias("host"), declared.alias("declared"), text.alias("t"))
    rows = wide.mapInArrow(
        compute, "id long, host string, declared string, n_letters long, logits array<double>, p array<double>"
    )
    known = F.when(F.col("declared").isin(*model.languages), F.col("declared")).when(F.col("declared").isNotNull(), "other")
    labels = F.split("host", r"\.")
    return staged(
        rows.withColumn("declared", F.coalesce(known, F.lit("none")))
        .withColumn("suffix", F.coalesce(F.element_at(labels, -1), F.lit("none")))
        .withColumn("domain", F.coalesce(F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), "."), F.lit("none"))),
        "evidence",
    )


def fuse(rows: DataFrame, languages: list[str]) -> DataFrame:
    """``(id, ..., lang, posterior)``: the most probable language, given all evidence.

    Grouped sums of the texts' posteriors give, for every declared language and
    suffix, how often it goes with a language, and for every host how its pages
    are written: smoothed towards its domain, and that towards all pages. The
    row itself is taken out of the sums of its host and domain. Every group is
    one row per key; sums are partial before the shuffle, so a host with any
    share of the pages is no hot spot. Rows without letters get ``und`` and
    posterior 0.
    """
    n = len(languages)
    sums = lambda: F.array(*[F.sum(F.col("p")[i]) for i in range(n)])
    told = rows.filter("n_letters > 0")
    total = told.agg(sums().alias("s")).first()["s"]
    if total[0] is None:
        total = [0.0] * n
    prior = [(t + PSEUDO_PAGES / n) / (sum(total) + PSEUDO_PAGES) for t in total]
    grouped = {key: told.groupBy(key).agg(sums().alias(f"s_{key}")) for key in ("host", "domain", "declared", "suffix")}
    joined = rows
    for key, table in grouped.items():
        joined = joined.join(table, key, "left")
    own = F.when(F.col("n_letters") > 0, F.col("p")).otherwise(F.array(*[F.lit(0.0)] * n))
    for key in grouped:
        joined = joined.withColumn(f"s_{key}", F.coalesce(f"s_{key}", F.array(*[F.lit(0.0)] * n)))
    added = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    less = lambda a: F.zip_with(a, own, lambda x, y: F.greatest(x - y, F.lit(0.0)))

    def smoothed(counts: Column, wider: Column) -> Column:
        return F.zip_with(counts, wider, lambda c, w: (c + PSEUDO_PAGES * w) / (added(counts) + PSEUDO_PAGES))

    def likelihood(counts: Column) -> Column:
        """P(key | language), up to a factor that all languages share."""
        key_share = (added(counts) + 1.0) / (sum(total) + 1.0)
        pairs = F.arrays_zip(counts.alias("c"), F.array(*[F.lit(t) for t in total]).alias("t"))
        return F.transform(pairs, lambda x: F.log((x["c"] + PSEUDO_PAGES * key_share) / (x["t"] + PSEUDO_PAGES)))

    every = F.array(*[F.lit(x) for x in prior])
    joined = joined.withColumn("host_prior", smoothed(less(F.col("s_host")), smoothed(less(F.col("s_domain")), every)))
    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    logits = plus(
        plus(F.col("logits"), F.transform("host_prior", lambda x: F.log(x))),
        plus(likelihood(F.col("s_declared")), likelihood(F.col("s_suffix"))),
    )
    joined = joined.withColumn("fused", logits).withColumn("best", F.array_max("fused"))
    posterior = 1 / added(F.transform("fused", lambda x: F.exp(x - F.col("best"))))
    names = F.array(*[F.lit(x) for x in languages])
    written = F.col("n_letters") > 0
    return joined.select(
        "id", "host", "suffix", "declared", "n_letters",
        F.when(written, F.element_at(names, F.array_position("p", F.array_max("p")).cast("int"))).otherwise(UNKNOWN).alias("text_lang"),
        F.when(written, F.element_at(names, F.array_position("fused", F.col("best")).cast("int"))).otherwise(UNKNOWN).alias("lang"),
        F.when(written & F.lit(languages != [UNKNOWN]), posterior).otherwise(F.lit(0.0)).alias("posterior"),
    )


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """Language of every row of ``pages (page_id, url, html)``.

    Null or empty pages are ``und`` with posterior 0; a null or relative address
    has no host and the suffix ``none``; a page without a declared language has
    ``none``, an unknown one ``other``. Repeated rows are rows of their own, ties
    go to the first language in order, other columns are not read, and an empty
    table gives no rows.
    """
    return fuse(page_evidence(pages, model), model.languages).withColumnRenamed("id", "page_id")


def identify_documents(docs: DataFrame, model: TextModel) -> DataFrame:
    """Language of ``docs (doc_id, text, source)``, with the source as host; nothing is declared."""
    rows = evidence(docs, model, F.col("doc_id"), F.col("text"), F.col("source"), F.lit(None).cast("string"))
    return fuse(rows, model.languages).withColumnRenamed("id", "doc_id")
