"""Repeated word sequences against the plain definition."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from lettermill.llm import substrings


def plain(rows, window):
    """doc_id -> (n_words, n_removed, digest)"""
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in sorted(rows)]
    seen, out = set(), {}
    for i, words in docs:
        gone = set()
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                gone.update(range(s, s + window))
            seen.add(key)
        kept = [w for k, w in enumerate(words) if k not in gone]
        out[i] = (len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def make_rows(seed):
    rng = random.Random(seed)
    vocab = ["a", "b", "été", "x y", "don't", "Ünï"] + [f"w{i}" for i in range(rng.choice([3, 40, 4000]))]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    passages = [text(rng.randrange(15, 60)) for _ in range(4)]
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "same " * 70), (4, "same " * 25), (5, "one two")]
    for i in range(6, 60):
        words = text(rng.randrange(0, 90))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            at = rng.randrange(len(words) + 1)
            words[at:at] = p[rng.randrange(8) : len(p) - rng.randrange(8)]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(i + 100, t) for i, t in rng.sample(rows, 8)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,flush", [(1, 10), (2, 2_000_000), (3, 300)])
def test_equals_plain_version(spark, monkeypatch, seed, flush):
    monkeypatch.setattr(substrings, "FLUSH_WINDOWS", flush)
    rows = make_rows(seed)
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, start int, doc string").repartition(5)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.without_repeats(df).collect()}
    assert got == plain(rows, 20)


def test_text_keeps_its_space(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(1, f"head\n\n{passage}\ttail"), (2, f" lead\n{passage}\n\nend here ")]
    got = {r["doc_id"]: r["text"] for r in substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: " lead\nend here "}


def test_repeated_rows_null_ids_and_no_rows(spark):
    schema = "doc_id long, text string, n_removed string"
    long = " ".join(f"q{i}" for i in range(30))
    rows = [(4, long, "x"), (4, long, "x"), (None, long, "x"), (None, None, None)]
    got = [(r["doc_id"], r["n_removed"]) for r in substrings.without_repeats(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(got, key=str) == [(4, 0), (4, 0), (None, 0), (None, 30)]
    assert substrings.without_repeats(spark.createDataFrame([], schema)).count() == 0


def test_collisions_in_the_filter_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(substrings, "FILTER_BITS", 15)
    monkeypatch.setattr(substrings, "repeated_anchor_filter", lambda counts: (__import__("numpy").full(1 << 12, 255, "uint8"), 15))
    rows = make_rows(7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.without_repeats(df).collect()}
    assert got == plain(rows, 20)


def plain_rows(rows, window=20):
    """Kept words of every row; rows of one id, or of none, are never earlier than each other."""
    seen = {}
    words = [(10**18 if i is None else i, (t or "").split()) for i, t in rows]
    for n, (doc, ws) in enumerate(words):
        for at in range(len(ws) - window + 1):
            seen.setdefault(tuple(ws[at : at + window]), []).append((doc, n, at))
    kept = []
    for n, (doc, ws) in enumerate(words):
        gone = set()
        for at in range(len(ws) - window + 1):
            if any(d < doc or (m == n and s < at) for d, m, s in seen[tuple(ws[at : at + window])]):
                gone.update(range(at, at + window))
        kept.append((rows[n][0], " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(kept, key=str)


@pytest.mark.parametrize("flush", [2_000_000, 1])
def test_different_texts_of_one_id_or_none(spark, monkeypatch, flush):
    monkeypatch.setattr(substrings, "FLUSH_WINDOWS", flush)
    run = lambda c, n: [f"{c}{k}" for k in range(n)]
    rows = [(1, " ".join(run("a", 25))), (None, " ".join(run("a", 25) + run("x", 15))), (None, " ".join(run("u", 40)))]
    rows += [(None, " ".join(run("x", 5) + run("u", 40) + run("u", 40))), (7, " ".join(run("u", 30))), (7, " ".join(run("a", 22) + run("v", 30)))]
    rows += [(7, " ".join(run("v", 30) + run("z", 3))), (7, " ".join(run("v", 30) + run("z", 3))), (9, " ".join(run("v", 30) * 2)), (None, None), (None, "")]
    got = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(((r["doc_id"], " ".join((r["text"] or "").split())) for r in got), key=str) == plain_rows(rows)
    unique = next(r for r in got if "x14" in (r["text"] or ""))
    assert (unique["n_words"], unique["n_removed"]) == (40, 25)
