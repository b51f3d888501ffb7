"""Near-duplicate vectors against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from lettermill.llm import embeddings as em


def brute(ids, vectors, cosine=0.95):
    u = em.unit(vectors)
    link = u @ u.T >= cosine
    np.fill_diagonal(link, False)
    label = np.array(ids)
    while True:
        new = np.array([min([label[i], *label[link[i]]]) for i in range(len(ids))])
        if (new == label).all():
            return link, dict(zip(ids, label))
        label = new


def test_recall_and_no_false_links(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    rng = np.random.default_rng(0)
    vectors = np.array([r[1] for r in rows], float)
    noise = rng.standard_normal((600, vectors.shape[1])) * rng.uniform(0.01, 0.045, (600, 1))
    vectors = np.concatenate((vectors, vectors[:600] + noise))
    ids = list(range(len(vectors)))
    link, _ = brute(ids, vectors)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in em.near_vectors(df).collect()}
    n_true, n_got = link.sum(axis=1), np.array([got[i]["n_links"] for i in ids])
    assert (n_got <= n_true).all() and n_got.sum() >= 0.9 * n_true.sum() and n_true.sum() > 600


def test_hard_pairs_at_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(em, "SHARD_VECTORS", 64)  # many parts, so that parts ask each other
    rng = np.random.default_rng(1)
    base = em.unit(rng.standard_normal((800, 48)))
    away = rng.standard_normal(base.shape)
    away = em.unit(away - (away * base).sum(axis=1, keepdims=True) * base)
    near = 0.955 * base + np.sqrt(1 - 0.955**2) * away
    vectors = np.concatenate((base, near * 3.0, base[:20], base[:20]))
    ids = [int(i) for i in rng.permutation(len(vectors))]
    df = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, cid int")
    link, label = brute(ids, vectors)
    got = {r["vec_id"]: r for r in em.near_vectors(df).collect()}
    n_true, n_got = link.sum(axis=1), np.array([got[i]["n_links"] for i in ids])
    assert (n_got <= n_true).all() and n_got.sum() >= 0.9 * n_true.sum()
    for i, n, t in zip(ids, n_got, n_true):
        if n == t and label[i] == i:
            assert got[i]["kept"]
        assert got[i]["component_id"] >= label[i]


@pytest.mark.parametrize("common", [0.7, 0.8])
def test_hard_pairs_with_a_common_direction(spark, common):
    rng = np.random.default_rng(4)
    own = em.unit(rng.standard_normal((700, 64)))
    base = em.unit(np.sqrt(common) * em.unit(np.ones((1, 64))) + np.sqrt(1 - common) * own)
    away = rng.standard_normal(base.shape)
    away = em.unit(away - (away * base).sum(axis=1, keepdims=True) * base)
    vectors = np.concatenate((base, 0.955 * base + np.sqrt(1 - 0.955**2) * away))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    link, _ = brute(list(range(len(vectors))), vectors)
    got = {r["vec_id"]: r["n_links"] for r in em.near_vectors(df).collect()}
    n_true, n_got = link.sum(axis=1), np.array([got[i] for i in range(len(vectors))])
    assert (n_got <= n_true).all() and n_got.sum() >= 0.9 * n_true.sum() and n_true.sum() >= 1400


@pytest.mark.parametrize("limit", [16_384, 100])
def test_a_large_group_of_near_copies_counts_every_link(spark, monkeypatch, limit):
    monkeypatch.setattr(em, "HOT_PART", limit)
    monkeypatch.setattr(em, "SHARD_VECTORS", 400)
    rng = np.random.default_rng(2)
    one = rng.standard_normal(16)
    vectors = np.concatenate((one + 0.001 * rng.standard_normal((1500, 16)), rng.standard_normal((50, 16))))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in em.near_vectors(df).collect()}
    total = sum(got[i]["n_links"] for i in range(1500))
    assert 0.99 * 1500 * 1499 <= total <= 1500 * 1499
    assert {got[i]["component_id"] for i in range(1500)} == {0}


def test_vectors_that_ask_a_small_neighbour_are_dealt_too(spark, monkeypatch):
    """3,000 vectors of one part ask its neighbours, which have one member each: no task holds them all."""
    monkeypatch.setattr(em, "HOT_PART", 200)
    monkeypatch.setattr(em, "SHARD_VECTORS", 512)
    rng = np.random.default_rng(3)
    one = rng.standard_normal(12)
    bits, rows = 16, []
    for i in range(3000):
        rows.append((i, 1, [0b1111 << 12 | i % 7], [float(x) for x in one + 0.001 * rng.standard_normal(12)]))
    for k, lead in enumerate((0b0111, 0b1011, 0b1101, 0b1110)):
        rows.append((5000 + k, 1, [lead << 12 | 1], [float(x) for x in one]))
    classes = spark.createDataFrame(rows, "cid long, w long, code array<long>, v array<double>")
    n = 512 * 16
    sizes = em.deal_parts(classes, n, bits, 1).groupBy("table", "part", "a", "b").count().agg({"count": "max"}).first()[0]
    assert sizes < 700
    dealt = {r["cid"]: r["linked"] for r in em.shard_links(classes, n, bits, 1, 0.95, 1.0).groupBy("cid").sum("linked").withColumnRenamed("sum(linked)", "linked").collect()}
    monkeypatch.setattr(em, "HOT_PART", 1 << 30)
    whole = {r["cid"]: r["linked"] for r in em.shard_links(classes, n, bits, 1, 0.95, 1.0).groupBy("cid").sum("linked").withColumnRenamed("sum(linked)", "linked").collect()}
    assert dealt == whole and len(dealt) == 3004


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [1.0, inf]),
        (9, [None, 1.0]), (10, [0.0, 1.0]), (11, [-1.0, 0.0]), (None, [1.0, 0.0]), (12, [0.0, 1.0]), (12, [0.0, 1.0]), (13, [1e-320, 0.0]),
    ]
    got = em.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    found = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in got)
    assert found == [
        (0, 0, None, False), (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), *[(i, 0, i, True) for i in range(4, 10)],
        (10, 1, 10, True), (11, 0, 11, True), (12, 1, 10, False), (12, 1, 10, False), (13, 3, 1, False),
    ]


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_no_vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [tuple(r) for r in em.near_vectors(df).collect()] == [(i, 0, i, True) for i, _ in rows]


def test_tables_grow_with_the_number_of_vectors():
    assert em.plan_tables(1000)[0] == 16 and em.plan_tables(10**8)[0] == 27
    assert em.plan_tables(10**8)[1] > em.plan_tables(1000)[1]
