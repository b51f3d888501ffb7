"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.compare import compare, duck

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, DATA, contract.queries()[name], contract.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    rows = contract.entry(spark).collect()
    assert {r["status"] for r in rows} == {"ok", "short", "empty"}
    assert sum(r["n"] for r in rows) == 220


def test_known_counts(spark):
    stats = contract.queries()["processing_stats"](spark, "/root/testdata/sf0.01").first()
    assert (stats["processed"], stats["skipped_short"], stats["skipped_empty"]) == (851, 149, 100)
    assert stats["avg_words"] == stats["total_words"] / 851
    order = contract.queries()["seeded_shuffle"](spark, "/root/testdata/sf0.01").orderBy("position").take(5)
    assert [r["doc_id"] for r in order] == [863, 630, 574, 742, 110]
