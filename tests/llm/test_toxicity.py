"""Class models against a plain version, and accuracy on held-out rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lettermill.llm import toxicity as tx


def plain_ratios(docs, text):
    """docs: (toxic, text); the ratios of a text by the formulas, with dictionaries."""
    words = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())
    pairs = [Counter(), Counter()]
    for toxic, t in docs:
        w = words(t)
        pairs[toxic].update(set(zip([None, *w], w)))
    d = tx.DISCOUNT
    lower = [Counter(), Counter()]
    for c in (0, 1):
        for (_, w), n in pairs[c].items():
            lower[c][w] += min(n, d)
    total = [sum(x.values()) for x in lower]
    freed = [sum(min(n, d) for n in x.values()) for x in lower]
    rest = sum(freed) + 1
    p1 = lambda c, w: max(lower[c][w] - d, 0) / total[c] + freed[c] / total[c] * (min(lower[0][w], d) + min(lower[1][w], d)) / rest
    context = [Counter(), Counter()]
    left = [Counter(), Counter()]
    for c in (0, 1):
        for (v, _), n in pairs[c].items():
            context[c][v] += n
            left[c][v] += min(n, d)
    n_all = [sum(x.values()) for x in pairs]
    heavy = [tx.BACKOFF * 2 * n / sum(n_all) for n in n_all]
    out = []
    for v, w in zip([None, *words(text)], words(text)):
        weights = [(left[c][v] + heavy[c]) / (context[c][v] + heavy[c]) for c in (0, 1)]
        if w not in lower[0] and w not in lower[1]:
            out.append(math.log(weights[1] / weights[0]))
            continue
        two = [max(pairs[c][v, w] - d, 0) / (context[c][v] + heavy[c]) + weights[c] * p1(c, w) for c in (0, 1)]
        out.append(math.log(two[1] / two[0]))
    tail = math.ceil(len(out) / tx.TAIL_PART)
    return sum(out) / (tx.NEUTRAL_WORDS + len(out)), sum(sorted(out)[len(out) - tail :]) / (tx.NEUTRAL_TAIL + tail), max(out, default=0.0)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(60)] + ["été", "ÀB"]
    docs = []
    for i in range(400):
        toxic = i % 2
        words = [rng.choice(vocab) for _ in range(rng.randrange(5, 40))] + (rng.choices(["nasty", "vile"], k=3) if toxic else [])
        rng.shuffle(words)
        docs.append((i, " ".join(words), toxic))
    return docs


def test_ratios_equal_plain_version(spark, rows):
    df = spark.createDataFrame([(t, x, 1) for _, t, x in rows], "t string, toxic int, fold long")
    model = tx._ratios(tx._counts(df))
    texts = [t for _, t, _ in rows[:40]] + ["", "  ", "unknown words only", "Nasty, VILE!", "w1"]
    got = model.ratios(pa.array(texts))
    expected = [plain_ratios([(x, t) for _, t, x in rows], t) for t in texts]
    assert np.allclose(got, expected, atol=1e-5)
    assert (got[-2] > got[-1]).all()
    assert not got[-5].any() and not got[-4].any()


def test_scores_separate_and_ignore_other_columns(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(900, None, "x"), (901, "", "y"), (None, "nasty vile nasty", None)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = tx.fit(docs, labels.filter(~tx.held_out()))
    got = {r["doc_id"]: r for r in tx.with_toxicity(docs, model).collect()}
    assert len(got) == 403 and all(0 <= r["score"] <= 1 for r in got.values())
    held = [(got[i]["predicted"], x) for i, _, x in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(p == x for p, x in held) >= 0.9 * len(held)
    assert got[900]["score"] == got[901]["score"] and got[None]["predicted"] == 1


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = tx.fit(docs, labels.filter(~tx.held_out()))
    held = docs.join(labels, "doc_id").filter(tx.held_out()).select("toxic", "text")
    got = [(r["toxic"], r["predicted"]) for r in tx.with_toxicity(held, model).collect()]
    clean, toxic = [p for x, p in got if not x], [p for x, p in got if x]
    assert sum(clean) <= 0.01 * len(clean)
    assert sum(toxic) >= 0.8 * len(toxic)


@pytest.mark.parametrize("labels,score", [([], 0.5), ([(1, 0), (2, 0)], 0.001), ([(1, 1)], 0.999)])
def test_labels_of_one_class_and_no_rows(spark, labels, score):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = tx.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = [r["score"] for r in tx.with_toxicity(docs, model).collect()]
    assert np.allclose(got, [score] * 2)
    assert tx.with_toxicity(docs.limit(0), model).count() == 0
