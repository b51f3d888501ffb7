"""Bootstrap intervals: the same for any partitioning, and right as often as they say."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lettermill.operators import significance as sg

SCHEMA = "id long, side string, x int, y int"


def plain(rows, replicates):
    def draw(i):
        bits = []
        for j in range(-(-replicates // 8)):
            digest = hashlib.md5(f"42-{j}-{i}".encode()).hexdigest()
            bits += [int(digest[4 * k : 4 * k + 4], 16) for k in range(8)]
        return [sum(u >= s for s in sg.STEPS) for u in bits[:replicates]]

    counts = [[1, *draw(r[0])] for r in rows]
    deltas = []
    for b in range(replicates + 1):
        mean = {}
        for side in "lr":
            held = [(c[b], r[2] or 0) for r, c in zip(rows, counts) if r[1] == side]
            mean[side] = sum(k * x for k, x in held) / sum(k for k, _ in held)
        deltas.append(mean["r"] - mean["l"])
    return deltas[0], sorted(deltas[1:])


@pytest.mark.parametrize("parts", [1, 6])
def test_equals_the_plain_version(spark, parts):
    rng = random.Random(2)
    rows = [(i % 140, rng.choice("lrz"), rng.choice([None, 1, 2, 50]), 7) for i in range(160)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = {r["measure"]: r for r in sg.bootstrap_delta(df, "side", "l", "r", "id", {"x": F.col("x"), "y": F.col("y")}, 40, 0.9).collect()}
    delta, drawn = plain(rows, 40)
    assert (found["x"]["delta"], found["x"]["low"], found["x"]["high"]) == (delta, drawn[2], drawn[-3])
    assert (found["y"]["delta"], found["y"]["low"], found["y"]["high"], found["y"]["different"]) == (0, 0, 0, False)


def test_draws_have_the_mean_and_spread_of_a_poisson_number(spark):
    counts = [c for r in spark.range(300).select(sg.poisson_counts(1, F.col("id").cast("string"), 200).alias("c")).collect() for c in r["c"]]
    mean = sum(counts) / len(counts)
    assert len(counts) == 60_000 and abs(mean - 1) < 0.02 and abs(sum((c - mean) ** 2 for c in counts) / len(counts) - 1) < 0.03


def test_coverage_on_drawn_data(spark):
    """Sixty measures with known differences, drawn anew each: the interval holds the true one in about 95 of 100."""
    rng = random.Random(11)
    n, m = 240, 60
    true = [k % 3 * 10 for k in range(m)]
    rows = [(i, "lr"[i % 2], *[round(rng.gauss(100 + (true[k] if i % 2 else 0), 20)) for k in range(m)]) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, side string, " + ", ".join(f"m{k} long" for k in range(m)))
    found = {r["measure"]: r for r in sg.bootstrap_delta(df, "side", "l", "r", "id", {f"m{k}": F.col(f"m{k}") for k in range(m)}).collect()}
    held = sum(found[f"m{k}"]["low"] <= true[k] <= found[f"m{k}"]["high"] for k in range(m))
    assert held >= 52
    assert sum(found[f"m{k}"]["different"] for k in range(m) if true[k] == 20) == 20
    assert sum(found[f"m{k}"]["different"] for k in range(m) if true[k] == 0) <= 5


def test_a_missing_cohort_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "l", 3, 1), (None, "l", 5, 1), (1, None, 9, 9)], SCHEMA)
    row = sg.bootstrap_delta(df, "side", "l", "r", "id", {"x": F.col("x")}).first()
    assert row["left_value"] == 4 and [row[c] for c in ("right_value", "delta", "low", "high", "different")] == [None] * 5
    assert sg.bootstrap_delta(df.limit(0), "side", "l", "r", "id", {"x": F.col("x")}).count() == 0
