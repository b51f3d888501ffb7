"""Group-aware split: linked rows together, sizes as near the ratio as the groups allow."""

from __future__ import annotations

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from lettermill.operators import grouped_split as gs
from lettermill.plans import linked

SCHEMA = "id long, a string, b string, split string"


def best_sum(sizes, target):
    return min(abs(sum(s * n for s, n in zip(sizes, take)) - target) for take in product(*[range(c + 1) for c in sizes.values()]))


def plain_groups(rows):
    label = {r[0]: r[0] for r in rows}
    changed = True
    while changed:
        changed = False
        for x in rows:
            for y in rows:
                if any(x[k] is not None and x[k] == y[k] for k in (1, 2)) and label[x[0]] != label[y[0]]:
                    label[x[0]] = label[y[0]] = min(label[x[0]], label[y[0]])
                    changed = True
    return label


def split(spark, rows, ratio=0.9, parts=3, seed=42):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = gs.grouped_split(df, "id", [F.col("a"), F.col("b")], ratio, seed)
    assert found.columns == ["id", "a", "b", "group_id", "split"]
    return found.collect()


@pytest.mark.parametrize("seed", range(40))
def test_sums_equal_exhaustive_search(seed):
    rng = random.Random(seed)
    sizes = {s: rng.randrange(1, 4) for s in rng.sample(range(1, 40), rng.randrange(1, 6))}
    total = sum(s * c for s, c in sizes.items())
    for target in (0, total // 3, int(total * 0.9), total):
        chosen = gs.allot(sizes, target)
        assert all(0 <= chosen[s] <= c for s, c in sizes.items())
        assert abs(sum(s * n for s, n in chosen.items()) - target) == best_sum(sizes, target)


@pytest.mark.parametrize("seed", range(20))
def test_many_groups_stay_within_the_largest_and_are_exact_with_small_ones(seed, monkeypatch):
    monkeypatch.setattr(gs, "SUM_BITS", 5_000)
    rng = random.Random(seed)
    sizes = {s: rng.randrange(1, 50) for s in rng.sample(range(2, 900), 60)}
    total = sum(s * c for s, c in sizes.items())
    for ratio in (0.1, 0.5, 0.9):
        chosen = gs.allot(sizes, int(total * ratio))
        assert all(0 <= chosen[s] <= c for s, c in sizes.items())
        assert abs(sum(s * n for s, n in chosen.items()) - int(total * ratio)) <= 1
    sizes = {10**9: 1, 7: 100, 1: 10**9}
    assert sum(s * n for s, n in gs.allot(sizes, 18 * 10**8).items()) == 18 * 10**8


def test_groups_equal_the_plain_version(spark):
    rng = random.Random(4)
    word = lambda: rng.choice([None, *[f"k{k}" for k in range(60)]])
    rows = [(i, word(), word() if i % 3 else None, "old") for i in range(90)] + [(200 + i, None, None, None) for i in range(40)]
    label = plain_groups(rows)
    found = split(spark, rows)
    assert {r["id"]: r["group_id"] for r in found} == label
    sides = {}
    for r in found:
        sides.setdefault(r["group_id"], set()).add(r["split"])
    assert all(len(s) == 1 for s in sides.values())
    assert sum(r["split"] == "train" for r in found) == int(len(rows) * 0.9)
    for parts in (1, 16):
        assert sorted(split(spark, rows, parts=parts)) == sorted(found)
    assert sorted(split(spark, rows, seed=7)) != sorted(found)


def test_a_long_chain_and_a_hub_take_few_rounds(spark, monkeypatch):
    rounds = []
    real = linked.staged
    monkeypatch.setattr(linked, "staged", lambda df, name: (rounds.append(name), real(df, name))[1])
    n = 400
    rows = [(i, f"c{i // 2}", f"d{(i + 1) // 2}", None) for i in range(n)] + [(n + i, "hub", None, None) for i in range(300)]
    found = split(spark, rows, 0.5)
    assert {r["group_id"] for r in found} == {0, n}
    assert rounds.count("hops") < 40


def test_ranked_groups_share_no_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(gs, "BUCKET_GROUPS", 8)
    rows = [(i, None, None, None) for i in range(3000)]
    found = split(spark, rows, 0.37)
    assert sum(r["split"] == "train" for r in found) == 1110
    monkeypatch.setattr(gs, "BUCKET_GROUPS", 4_096)
    assert sorted(split(spark, rows, 0.37)) == sorted(found)


def test_repeated_ids_null_ids_and_empty_tables(spark):
    rows = [(1, "x", None, None)] * 3 + [(2, "x", None, None), (3, None, None, None), (4, None, None, None)]
    found = split(spark, rows, 0.5)
    assert len(found) == 6 and len({r["split"] for r in found if r["id"] in (1, 2)}) == 1
    assert split(spark, [], 0.9) == []
    with pytest.raises(ValueError, match="2 rows have a NULL id"):
        split(spark, [(None, "x", None, None)] * 2 + [(1, "x", None, None)])
    assert {r["split"] for r in split(spark, rows, 1.0)} == {"train"} and {r["split"] for r in split(spark, rows, 0.0)} == {"validation"}
