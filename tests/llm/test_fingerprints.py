"""Fingerprints against sets of paragraphs and plain string work."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from lettermill.llm import fingerprints as fp


def units(text):
    return set(re.findall(r"[^\n]{120,}?[.!?](?= |\n|$)|[^\n]+", text))


def plain(rows):
    docs = sorted(((i, t or "") for i, t in rows), reverse=True)
    out = {}
    for k, (i, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), like(units(text), units(edited)), like(units(text), units(after)))
    return out


def make_rows():
    rng = random.Random(4)
    sentence = lambda: " ".join(rng.choice(["a", "bé", "ccc", "x😀"]) for _ in range(rng.randrange(1, 40))) + rng.choice(".!?")
    lines = [" ".join(sentence() for _ in range(rng.randrange(1, 6))) for _ in range(80)]
    rows = [(i * 7 - 100, "\n".join(rng.choices(lines, k=rng.randrange(0, 30)))) for i in range(90)]
    rows += [(9_000, None), (9_001, ""), (9_002, "x"), (9_003, rows[5][1]), (9_004, "\n".join(f"line {k} of a long text." for k in range(3000)))]
    return rows


def test_equals_plain_version(spark, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_DOCS", 10)
    rows = make_rows()
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, u string, bucket int").repartition(4)
    got = {r["doc_id"]: r for r in fp.compare_versions(df).collect()}
    expected = plain(rows)
    assert len(got) == len(rows)
    for i, want in expected.items():
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) == want
    assert got[9_003]["fingerprint"] == got[rows[5][0]]["fingerprint"] != got[rows[6][0]]["fingerprint"]
    assert got[9_000]["fingerprint"] == got[9_001]["fingerprint"]


def test_ranges_stay_small_on_skewed_ids(spark, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_DOCS", 20)
    rng = random.Random(8)
    ids = list(range(1_000)) + [2**62, -(2**62)] + [2**50 + 3 * k for k in range(500)] + [7] * 800 + [None] * 900
    rows = [(i, f"text {k} {rng.random()}") for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    dealt = fp.with_ranges(df).select("*", F.xxhash64("text").alias("h")).collect()
    sizes = Counter(r["bucket"] for r in dealt)
    assert sum(sizes.values()) == len(rows) and max(sizes.values()) <= 70
    in_order = sorted(dealt, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"]))
    buckets = [r["bucket"] for r in in_order]
    assert buckets == sorted(buckets)
    got = {(r["doc_id"], r["text"]): r["next_text"] for r in fp.with_next(df.withColumn("u", fp.paragraphs(F.col("text")))).collect()}
    down = in_order[::-1]
    for r, after in zip(down, down[1:] + down[:1]):
        assert got[r["doc_id"], r["text"]] == after["text"]


def test_peeling_recovers_the_differing_digests(spark):
    df = spark.range(1).select(F.array(*[F.lit(x).cast("long") for x in (1, 2, 3, 4, 5)]).alias("a"), F.array(*[F.lit(x).cast("long") for x in (4, 5, 6)]).alias("b"))
    r = df.select(fp.peel(fp.subtract(fp.sketch(F.col("a")), fp.sketch(F.col("b")))).alias("p")).first()["p"]
    assert r["ok"] and sorted(r["left"]) == [1, 2, 3] and r["right"] == [6]


def test_repeated_rows_null_ids_and_no_rows(spark):
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(1, "a\nb"), (1, "a\nb"), (None, "c"), (None, None)], schema)
    assert sorted(r["n_chars"] for r in fp.compare_versions(df).collect()) == [0, 1, 3, 3]
    one = fp.compare_versions(spark.createDataFrame([(1, "abcdef")], schema)).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1.0
    assert fp.compare_versions(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = fp.compare_versions(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
