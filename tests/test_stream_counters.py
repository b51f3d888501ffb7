"""Keyed state on a stream against the same counters in batch, stopped and started between files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lettermill.operators.filtering import first_n_per_group
from lettermill.operators.reports import COUNTERS, counters
from lettermill.streaming.counters import admitted, latest_counters, mailbox_counters, write_counters

SCHEMA = "source string, place long, status string, n_words int"


def make(seed):
    rng = random.Random(seed)
    kinds = ["ok", "ok", "short", "empty", "error"]
    rows = [(rng.choice(["hot"] * 6 + ["b", "", None]), k * 3 - 500, rng.choice(kinds), rng.choice([None, 0, 5, 90])) for k in range(900)]
    return [rows[:50], rows[50:51], rows[51:700], rows[700:]], rows


def run(spark, folder, n):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = write_counters(mailbox_counters(stream, n), f"{folder}/out", f"{folder}/state")
    query.awaitTermination()
    return query


def as_rows(df):
    return sorted((tuple(r[c] for c in ("source", *COUNTERS)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n", [None, 40, 1])
def test_stream_equals_batch_after_every_stop(spark, tmp_path, n):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        files, rows = make(n or 7)
        so_far = []
        for part in files:
            shuffled = random.Random(1).sample(part, len(part))
            spark.createDataFrame(shuffled, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            run(spark, tmp_path, n)
            so_far += part
            batch = first_n_per_group(spark.createDataFrame(so_far, SCHEMA), "source", "place", n)
            found = latest_counters(spark, f"{tmp_path}/out")
            assert as_rows(found) == as_rows(batch.groupBy("source").agg(*counters()))
            assert found.agg(F.sum("late")).first()[0] == 0
        kept = admitted(spark.createDataFrame(rows, SCHEMA), found)
        assert sorted(map(tuple, kept.collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)
        before = spark.read.parquet(f"{tmp_path}/out").count()
        run(spark, tmp_path, n)  # nothing new: nothing is written
        assert spark.read.parquet(f"{tmp_path}/out").count() == before
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_late_messages_are_told(spark, tmp_path):
    for part in ([("a", 10, "ok", 3)], [("a", 5, "ok", 4), ("a", 11, "short", 1), ("a", None, "ok", 9), ("a", 12, "ok", 2)]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run(spark, tmp_path, 2)
    row = latest_counters(spark, f"{tmp_path}/out").first()
    assert (row["total"], row["late"], row["upto"], row["total_words"]) == (2, 1, 11, 3)


def test_empty_input(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in")
    run(spark, tmp_path, 3)
    assert spark.read.schema("source string, total long").parquet(f"{tmp_path}/out").count() == 0
