"""Ranked lexical search against a plain version of the definition."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from lettermill.llm import lexical

DOCS, ITEMS = "doc_id long, text string, rank string", "item_id long, text string, score string"


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t, *_ in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t, *_ in items:
        asked.setdefault(i, set()).update(terms(t))
    rows = []
    for item, words in asked.items():
        scores = []
        for doc, bag in bags:
            m = 100 - 90 + (90 * sum(bag.values()) * n_docs) // total
            score = 0
            for t in words & set(bag):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, no_id, doc) in enumerate(sorted(scores)[:top], 1):
            rows.append((item, rank, None if no_id else doc, -score))
    return sorted(rows, key=repr)


def ranked(spark, docs, items, top=10):
    found = lexical.rank_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), top)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


def make(seed, n=400):
    rng = random.Random(seed)
    vocab = ["the", "The", "of", "été", "x-y", "B2"] + [f"w{k}" for k in range(300)]
    pick = lambda: vocab[min(int(rng.expovariate(0.05)), len(vocab) - 1)]
    docs = [(i, " ".join(pick() for _ in range(rng.choice([1, 5, 30, 200]))), "r") for i in range(n)]
    docs += [(1000 + k, docs[3][1], "copy") for k in range(60)] + [(3, docs[3][1], "copy"), (None, docs[3][1], None)]
    docs += [(2000, None, None), (2001, "", None), (2002, "?! ", None), (2003, "long " * 20000 + "w7", None)]
    items = [(k, " ".join(pick() for _ in range(rng.choice([1, 3, 12, 60]))), "s") for k in range(25)]
    items += [(0, "w250 zzz", None), (None, "w1 the", None), (90, None, None), (91, "", None), (92, "nowhere", None), (93, docs[3][1], None)]
    return docs, items


@pytest.mark.parametrize("shard, step, short", [(1 << 20, 1024, 16), (3000, 8, 4), (3000, 1, 1 << 30)])
def test_equals_the_plain_version(spark, monkeypatch, shard, step, short):
    monkeypatch.setattr(lexical, "SHARD_BYTES", shard)
    monkeypatch.setattr(lexical, "STEP", step)
    monkeypatch.setattr(lexical, "SHORT", short)
    docs, items = make(shard % 7)
    assert ranked(spark, docs, items) == plain(docs, items)
    assert ranked(spark, docs, items, top=3) == plain(docs, items, 3)


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    docs, items = make(5, 150)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 40)
    assert ranked(spark, docs, items) == plain(docs, items)


def test_partitions_change_nothing(spark):
    docs, items = make(8, 200)
    found = [
        sorted(map(tuple, lexical.rank_documents(spark.createDataFrame(docs, DOCS).repartition(n), spark.createDataFrame(items, ITEMS)).collect()), key=repr)
        for n in (1, 13)
    ]
    assert found[0] == found[1] == plain(docs, items)


def test_a_list_that_cannot_reach_the_floor_is_not_walked(monkeypatch):
    """Ten documents with a rare term are in; the list of the frequent term is only looked into."""
    import numpy as np
    import pyarrow as pa

    texts = ["rare word " * 3] * 12 + ["word and more of it"] * 5000
    batch = pa.RecordBatch.from_pydict({"i": list(range(len(texts))), "t": texts})
    row = next(lexical._shards(iter([batch]))).to_pylist()[0]
    words = ["rare", "word"]
    hashes = lexical.word_hashes(lexical.split_words(pa.array(words)))
    order = np.argsort(hashes)
    corpus = lexical.Corpus(row["n_docs"], row["n_terms"])
    df = {"rare": 12, "word": len(texts)}
    weights = np.array([corpus.weight(df[w]) for w in words], np.int64)[order]
    items = lexical.Items([0], hashes[order], np.maximum(weights, 1), [np.array([0, 1])])
    best, looked = lexical.Best(10), []
    real = np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *r: (looked.append(np.size(v)) if len(a) == len(texts) else None, real(a, v, *r))[1])
    lexical.Shard(row, items, corpus).search(np.array([0, 1]), best)
    assert best.ids.tolist() == list(range(10)) and sum(looked) < 100


def test_empty_tables(spark):
    docs, items = make(1, 20)
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == []
    assert ranked(spark, [(1, None, None), (2, " . ", None)], items) == []
