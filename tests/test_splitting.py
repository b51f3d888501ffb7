from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from lettermill.operators import reports
from lettermill.operators.filtering import first_n_per_group
from lettermill.operators.splitting import seeded_shuffle, train_val_split
from lettermill.plans import ranking
from lettermill.plans.corpus import split_corpus
from lettermill.sources import jsonl


def ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "doc_id")


def split_of(df):
    return {r["doc_id"]: r["split"] for r in df.collect()}


@pytest.mark.parametrize("n, ratio, size", [(100, 0.29, 28), (1000, 0.9, 900), (7, 0.5, 3), (5, 1.0, 5), (5, 0.0, 0), (0, 0.9, 0)])
def test_exact_size_in_hash_order(spark, n, ratio, size):
    found = split_of(train_val_split(ids(spark, n), "doc_id", ratio))
    order = sorted(range(n), key=lambda i: hashlib.md5(f"42-{i}".encode()).hexdigest())
    assert found == {i: "train" if at < size else "validation" for at, i in enumerate(order)}


def test_same_split_for_any_partitioning(spark):
    base = split_of(train_val_split(ids(spark, 500), "doc_id"))
    for partitions in (1, 4, 64):
        assert split_of(train_val_split(ids(spark, 500).repartition(partitions), "doc_id")) == base
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        assert split_of(train_val_split(ids(spark, 500), "doc_id")) == base
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_second_histogram_level(spark, monkeypatch):
    base = split_of(train_val_split(ids(spark, 3000), "doc_id", 0.31))
    monkeypatch.setattr(ranking, "PREFIX", 1)
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 10)
    assert split_of(train_val_split(ids(spark, 3000), "doc_id", 0.31)) == base


def test_rows_without_id_and_with_many_copies(spark):
    rows = spark.range(600).select(F.when(F.col("id") < 400, "same").otherwise(F.col("id").cast("string")).alias("line"))
    for ratio in (0.1, 0.29, 0.5, 0.9):
        found = train_val_split(rows, ratio=ratio).groupBy("line", "split").count().collect()
        assert sum(r["count"] for r in found if r["split"] == "train") == int(600 * ratio)
        assert sum(r["count"] for r in found if r["line"] == "same") == 400
        assert sum(r["count"] for r in found) == 600


def test_null_ids_are_an_error(spark):
    rows = spark.range(100).select(F.when(F.col("id") >= 20, F.col("id")).alias("id"))
    for ratio in (0.1, 0.9):
        with pytest.raises(ValueError, match="20 rows have a NULL id"):
            train_val_split(rows, "id", ratio)


def test_ids_must_be_unique_at_the_cut(spark):
    with pytest.raises(ValueError, match="not unique"):
        train_val_split(spark.createDataFrame([(1,)] * 10, "doc_id long"), "doc_id", 0.5)


def test_positions_are_a_permutation(spark):
    rows = seeded_shuffle(ids(spark, 2000), "doc_id").orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(2000))
    order = sorted(range(2000), key=lambda i: hashlib.md5(f"42-{i}".encode()).hexdigest())
    assert [r["doc_id"] for r in rows] == order


def test_labelling_has_no_shuffle(spark):
    plan = train_val_split(ids(spark, 100), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


@pytest.mark.parametrize("n", [1, 5, 90, 5000])
@pytest.mark.parametrize("boundary", [1_000_000, 3])
def test_first_n_per_group(spark, monkeypatch, n, boundary):
    from lettermill.operators import filtering

    monkeypatch.setattr(filtering, "BOUNDARY_ROWS", boundary)
    # half of the rows without a source, ids unevenly spaced over all of long
    rows = spark.range(2000).select(
        F.when(F.col("id") % 2 == 1, F.concat(F.lit("s"), (F.col("id") % 30).cast("string"))).alias("source"),
        F.expr("case id when 0 then -9223372036854775807 - 1 when 1998 then 9223372036854775807 else id * id end").alias("doc_id"),
    )
    expected = {}
    for r in rows.orderBy("doc_id").collect():
        expected.setdefault(r["source"], []).append(r["doc_id"])
    found = {}
    for r in first_n_per_group(rows, "source", "doc_id", n).orderBy("doc_id").collect():
        found.setdefault(r["source"], []).append(r["doc_id"])
    assert found == {k: v[:n] for k, v in expected.items()}


def test_limit_by_an_order_that_is_not_unique(spark, monkeypatch):
    from lettermill.operators import filtering

    monkeypatch.setattr(filtering, "BOUNDARY_ROWS", 3)
    rows = spark.range(100).select(F.lit("a").alias("source"), F.lit(7).alias("doc_id"))
    with pytest.raises(ValueError, match="not unique"):
        first_n_per_group(rows, "source", "doc_id", 5)


def test_no_limit_keeps_all(spark):
    assert first_n_per_group(ids(spark, 10), "doc_id", "doc_id", 0).count() == 10
    assert first_n_per_group(ids(spark, 10), "doc_id", "doc_id", None).count() == 10


def test_reports_of_empty_input(spark):
    none = spark.createDataFrame([], "status string, n_words int, split string, language string")
    stats = reports.processing_stats(none).first()
    assert stats["total"] == 0 and stats["total_words"] == 0 and stats["avg_words"] is None
    assert reports.split_stats(none).count() == 0
    assert reports.language_distribution(none).count() == 0


def test_split_corpus_round_trip(spark, tmp_path):
    examples = spark.range(50).select(
        F.array(F.struct(F.lit("assistant").alias("role"), F.concat(F.lit("é "), F.col("id").cast("string")).alias("content"))).alias("messages"),
        F.struct(F.lit("nl").alias("language"), F.lit(3).alias("word_count"), F.lit(None).cast("string").alias("subject")).alias("metadata"),
    )
    out = str(tmp_path / "corpus")
    split_corpus(examples, out, 0.9, 42)
    train, rest = (jsonl.read_split(spark, out, s) for s in ("train", "validation"))
    assert (train.count(), rest.count()) == (45, 5)
    back = train.unionByName(rest).drop(jsonl.CORRUPT)
    assert sorted(back.collect(), key=str) == sorted(examples.collect(), key=str)
    line = spark.read.text(out + "/split=train").first()[0]
    assert "é" in line and '"subject":null' in line


def test_bad_lines_are_kept_as_rejects(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"messages":[{"role":"user","content":"a"}]}\n{broken\n{"messages":null}\n', encoding="utf-8")
    rows = jsonl.read_examples(spark, str(path))
    assert rows.count() == 3
    assert jsonl.readable(rows).count() == 2 and jsonl.rejects(rows).count() == 1
    assert [r[jsonl.CORRUPT] for r in jsonl.rejects(rows).collect()] == ["{broken"]
    assert rows.filter("metadata is null").count() == 3
