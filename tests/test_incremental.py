"""Counters taken with the write, and the repeatable build."""

from __future__ import annotations

import os
import shutil

import pytest

from lettermill.operators.language import LanguageModel
from lettermill.operators.reports import observed_stats, processing_stats, with_observed_counters
from lettermill.plans import corpus, incremental
from lettermill.session import staged
from lettermill.sources.jsonl import read_examples
from tests.test_mailbox import single, write

WORDS = "one two three four five six seven eight nine ten"
SCHEMA = "status string, n_words int"


@pytest.fixture(scope="module")
def model(spark):
    return LanguageModel.fit(spark.createDataFrame([(WORDS, "en"), ("een twee drie", "nl")], "text string, lang string"))


@pytest.mark.parametrize("parts", [1, 7])
def test_observed_counters_equal_the_aggregate(spark, parts):
    rows = [("ok", 10 + i) for i in range(50)] + [("short", 3), ("empty", 0), ("error", None), (None, None), ("ok", None)]
    for held in (rows, [("short", 1)], []):
        judged, seen = with_observed_counters(spark.createDataFrame(held, SCHEMA).repartition(parts))
        written = staged(judged, "judged")
        assert observed_stats(spark, seen).collect() == processing_stats(written).collect()


def test_build_takes_its_counters_from_the_write(spark, tmp_path, model, monkeypatch):
    write(tmp_path / "in" / "a.mbox", [single(f"s{i}", WORDS) for i in range(4)] + [single("s", "short")])
    monkeypatch.setattr("lettermill.operators.reports.processing_stats", lambda *_: pytest.fail("the judged table was read again"))
    stats = corpus.build_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), model).first()
    assert (stats["total"], stats["processed"], stats["skipped_short"], stats["avg_words"]) == (5, 4, 1, 10.0)


def listing(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs}


def test_only_changed_mailboxes_are_read_and_replaced(spark, tmp_path, model, monkeypatch):
    boxes, out = tmp_path / "in", str(tmp_path / "out")
    for box in ("A", "B", "c [1] {x}, y*"):
        write(boxes / f"{box}.mbox" / "mbox", [single(f"{box}{i}", WORDS) for i in range(3)] + [single("s", "short")])
    read = []
    real = incremental.read_messages
    monkeypatch.setattr(incremental, "read_messages", lambda s, f: (read.append(len(f)), real(s, f))[1])

    def update(**kw):
        row = incremental.update_corpus(spark, str(boxes), out, model, **kw).first()
        found = read_examples(spark, out).groupBy("mailbox").count().collect()
        return row, {r["mailbox"].rsplit("-", 1)[0]: r["count"] for r in found}

    first, found = update()
    assert (first["total"], first["processed"], first["rebuilt"], first["removed"]) == (12, 9, 3, 0) and sorted(found.values()) == [3, 3, 3]
    before = listing(out)
    again, _ = update()
    assert (again["total"], again["processed"], again["total_words"], again["rebuilt"]) == (12, 9, first["total_words"], 0)
    assert listing(out) == before and read == [3]

    write(boxes / "B.mbox" / "mbox", [single(f"new{i}", WORDS) for i in range(5)])
    grown, found = update()
    assert (grown["total"], grown["processed"], grown["rebuilt"]) == (13, 11, 1) and found["B"] == 5 and found["A"] == 3
    assert all(before[f] == t for f, t in listing(out).items() if f in before and "mailbox=B" not in f)
    assert read == [3, 1]

    shutil.rmtree(boxes / "A.mbox")
    write(boxes / "B.mbox" / "mbox", [single("s", "short")])
    less, found = update()
    assert (less["total"], less["processed"], less["rebuilt"], less["removed"]) == (5, 3, 1, 1) and len(found) == 1
    full = corpus.build_corpus(spark, str(boxes), str(tmp_path / "full"), model).first()
    assert (full["total"], full["processed"], full["total_words"]) == (less["total"], less["processed"], less["total_words"])
    rebuilt, _ = update(version="2")
    assert rebuilt["rebuilt"] == 2 and rebuilt["total"] == 5


def test_a_run_that_stops_half_way_is_made_good(spark, tmp_path, model, monkeypatch):
    boxes, out = tmp_path / "in", str(tmp_path / "out")
    write(boxes / "A.mbox", [single(f"a{i}", WORDS) for i in range(3)])
    real = incremental._report
    incremental.update_corpus(spark, str(boxes), out, model)
    write(boxes / "A.mbox", [single(f"a{i}", WORDS) for i in range(6)])
    monkeypatch.setattr(incremental, "staged", lambda df, name: pytest.fail("stop") if name == "rebuilt" else staged(df, name))
    with pytest.raises(BaseException, match="stop"):
        incremental.update_corpus(spark, str(boxes), out, model)
    monkeypatch.setattr(incremental, "staged", staged)
    assert real is incremental._report
    assert incremental.update_corpus(spark, str(boxes), out, model).first()["processed"] == 6
    assert read_examples(spark, out).count() == 6


def test_no_mailbox_is_an_error(spark, tmp_path, model):
    with pytest.raises(FileNotFoundError):
        (tmp_path / "in").mkdir()
        incremental.update_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), model)
