"""Language model against the formulas with dictionaries."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from lettermill.llm import lm


def plain(train, texts):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["</s>"]
    uni, pairs = Counter(), Counter()
    for t in train:
        w = words(t)
        uni.update(w)
        pairs.update(zip(["<s>", *w], w))
    n, types = sum(uni.values()), len(uni)
    follows, total = Counter(), Counter()
    parts = defaultdict(Counter)
    for (v, w), c in pairs.items():
        follows[w] += 1
        total[v] += c
        parts[v][min(c, 3)] += 1
    coc = lambda values: [sum(x == i for x in values) for i in range(1, 5)]
    d2, d1 = lm.discounts(coc(pairs.values())), lm.discounts(coc(follows.values()))
    left = sum(d1[min(c, 3)] for c in follows.values()) / len(pairs) if pairs else 1.0
    out = []
    for t in texts:
        w = words(t)
        base = sum(math.log10((uni[x] + 0.5) / (n + 0.5 * (types + 1))) for x in w)
        score = 0.0
        for v, x in zip(["<s>", *w], w):
            low = max(follows[x] - d1[min(follows[x], 3)], 0) / max(1, len(pairs)) + left / (types + 1)
            back = sum(d2[k] * m for k, m in parts[v].items()) / total[v] if total[v] else 1.0
            c = pairs[v, x]
            score += math.log10(max(c - d2[min(c, 3)], 0) / max(1, total[v]) + back * low)
        out.append((len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(50)] + ["Été", "DON'T", "a,b"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choices(vocab, weights, k=rng.randrange(60)))) for i in range(150)]
    return rows + [(200, None), (201, ""), (202, "new words only here"), (203, rows[3][1])]


@pytest.mark.parametrize("flush,shard", [(100, 500), (4_000_000, 8 << 20)])
def test_scores_equal_plain_version(spark, rows, monkeypatch, flush, shard):
    monkeypatch.setattr(lm, "FLUSH_TOKENS", flush)
    monkeypatch.setattr(lm, "SCORE_TOKENS", flush)
    monkeypatch.setattr(lm, "SHARD_BYTES", shard)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string").repartition(3)
    model = lm.fit(df.filter(~lm.held_out()))
    got = {r["doc_id"]: r for r in lm.with_scores(df, model).collect()}
    expected = plain([t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1], [t for _, t in rows])
    for (i, _), (n, known, total, base, score) in zip(rows, expected):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], score, rel_tol=1e-9)
        assert math.isclose(r["perplexity"], 10 ** (-score / n), rel_tol=1e-6)


def test_better_than_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = lm.fit(docs.filter(~lm.held_out()))
    sums = lm.with_scores(docs.filter(lm.held_out()), model).groupBy().sum("score", "base_score").first()
    assert sums[0] > sums[1]


def test_no_rows_and_no_training_text(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = lm.fit(none)
    assert lm.with_scores(none, model).count() == 0
    row = lm.with_scores(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), model).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)
    assert math.isclose(row["score"], 0.0, abs_tol=1e-9)


def test_probabilities_sum_to_one(spark, rows):
    import numpy as np
    import pyarrow as pa

    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm.fit(df)
    vocab = sorted({w.decode() for _, t in rows for w in (t or "").encode().lower().split()})
    _, _, after = lm.tokens(pa.array([" ".join(vocab)]))  # all words and the end
    for context in (lm.START, after[0], np.uint64(12345)):
        _, _, p = model.log10(np.full(len(after), context), after)
        unknown = model.log10(np.array([context]), np.array([np.uint64(99)]))[2]
        assert math.isclose((10**p).sum() + 10 ** unknown[0], 1.0, rel_tol=1e-6)


def test_a_folder_that_cannot_be_mapped_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(lm, "scratch_path", lambda s, n: "hdfs://x/y")
    with pytest.raises(ValueError):
        lm.shared_folder(spark, "m")
