from __future__ import annotations

import mailbox
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lettermill.functions.mime import decode_utf8
from lettermill.operators.bodies import header_projection, nested_body
from lettermill.operators.language import LanguageModel
from lettermill.plans.corpus import build_corpus, judge_messages
from lettermill.plans.incremental import update_corpus
from lettermill.sources import mailbox as source
from lettermill.sources.jsonl import read_examples


def single(subject, body, headers=""):
    return f"Subject: {subject}\nTo: you@example.com\n{headers}\n{body}\n".encode()


def multipart(subject, *parts):
    inner = "".join(f"--b\n{headers}\n\n{body}\n" for headers, body in parts)
    return f'Subject: {subject}\nContent-Type: multipart/mixed; boundary="b"\n\n{inner}--b--\n'.encode()


def write(path, messages, gap=b"\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"".join(b"From a@example.com Mon Jan  1 00:00:00 2024\n" + m + gap for m in messages))


def read(spark, path, limit=None):
    staged = spark.createDataFrame(source.read_messages(spark, str(path), limit).collect(), source.MESSAGE_SCHEMA)
    return source.with_message_index(staged, limit)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def standard_library(path):
    found = []
    for message in mailbox.mbox(str(path)):
        parts = [
            p.get_payload(decode=True)
            for p in message.walk()
            if p.get_content_type() in ("text/plain", "text/html")
        ]
        found.append((message["Subject"], message.is_multipart(), parts))
    return found


@pytest.mark.parametrize("gap", [b"\n", b""])
def test_same_messages_in_order_over_many_splits(spark, tmp_path, small_splits, gap):
    rng = random.Random(3)
    messages = []
    for i in range(300):
        body = "\n".join("line %d" % rng.randint(0, 99) for _ in range(rng.randint(0, 30)))
        if i % 3:
            messages.append(single(i, body))
        else:
            messages.append(multipart(i, ("Content-Type: text/html", f"<p>{body}</p>"), ("Content-Type: text/plain", body)))
    path = tmp_path / "Sent.mbox"
    write(path, messages, gap)
    rows = read(spark, path).orderBy("msg_idx").collect()
    assert len({r["block_start"] for r in rows}) > 10
    assert [r["msg_idx"] for r in rows] == list(range(300))
    ours = [
        (r["headers"]["Subject"], r["multipart"], [p["payload"] for p in r["parts"] if p["payload"] is not None])
        for r in rows
    ]
    assert ours == standard_library(path)


@pytest.mark.parametrize("limit", [1, 7, 150, 1000])
def test_limit_counts_messages_in_order(spark, tmp_path, small_splits, limit):
    for box in ("A", "B"):
        write(tmp_path / f"{box}.mbox" / "mbox", [single(f"{box}{i}", "x" * (i % 90)) for i in range(200)])
    rows = read(spark, tmp_path, limit).collect()
    for box in ("A", "B"):
        subjects = {r["headers"]["Subject"] for r in rows if r["source"].endswith(f"{box}.mbox")}
        assert subjects == {f"{box}{i}" for i in range(min(limit, 200))}


def test_text_before_the_first_envelope_is_no_message(spark, tmp_path):
    path = tmp_path / "x.mbox"
    path.write_bytes(b"junk\nFrom a\nSubject: one\n\nbody\n\nFrom b\nSubject: two\n\nbody\n")
    rows = read(spark, path).orderBy("msg_idx").collect()
    assert [(r["msg_idx"], r["headers"]["Subject"]) for r in rows] == [(0, "one"), (1, "two")]
    (tmp_path / "y.mbox").write_bytes(b"no envelope at all\n")
    assert read(spark, tmp_path / "y.mbox").count() == 0


def test_discovery_reads_each_mailbox_once(spark, tmp_path):
    for name in ("A.mbox/mbox", "B.mbox/mbox", "x/y.mbox", "x/z.txt", "plain/mbox", "deep/er/C.mbox/D.mbox"):
        write(tmp_path / name, [single(name, "body")])
    found = {r["file"].split(tmp_path.name + "/")[1] for r in source.find_mailboxes(spark, str(tmp_path)).collect()}
    assert found == {"A.mbox/mbox", "B.mbox/mbox", "x/y.mbox", "deep/er/C.mbox/D.mbox"}
    rows = read(spark, tmp_path).collect()
    assert sorted(r["headers"]["Subject"] for r in rows) == sorted(found)
    assert len({r["source"] for r in rows}) == 4


def test_a_mailbox_of_any_name(spark, tmp_path):
    write(tmp_path / "Sent", [single("one", "body"), single("two", "body")])
    assert source.read_messages(spark, str(tmp_path / "Sent"), any_name=True).count() == 2
    assert source.read_messages(spark, str(tmp_path)).count() == 0


def bodies(spark, path):
    rows = nested_body(header_projection(read(spark, path))).orderBy("msg_idx").collect()
    return [r["body"] for r in rows]


def test_body_choice(spark, tmp_path):
    html, plain = "Content-Type: text/html", "Content-Type: text/plain"
    attached = "\nContent-Disposition: attachment; filename=a.txt"
    path = tmp_path / "x.mbox"
    write(
        path,
        [
            multipart(0, (html, "<p>page</p>"), (plain, "text")),
            multipart(1, (html, "<p>page</p>")),
            multipart(2, (plain + attached, "no"), (html, "<b>yes</b>")),
            multipart(3, (plain + attached, "no")),
            multipart(4, (plain + attached.replace("attachment", "Attachment"), "capital")),
            multipart(5, (plain, ""), (html, "<p>x</p>")),
            single(6, "alone", "Content-Disposition: attachment\n"),
            single(7, "<p>a</p>", "Content-Type: text/html\n"),
            single(8, "none", "Content-Type: text/calendar\n"),
            multipart(9, (plain + "\nContent-Transfer-Encoding: base64", "aGk="), (html, "x")),
            multipart(10, (plain + "\nContent-Transfer-Encoding: quoted-printable", "caf=C3=A9")),
        ],
    )
    assert bodies(spark, path) == [
        "text", "page", "**yes**", None, "capital", "", "alone\n", "a", None, "hi", "café",
    ]


def test_bad_bytes_and_bad_headers(spark, tmp_path):
    path = tmp_path / "x.mbox"
    write(path, [b"Subject: a\n\na\xffb\n", b"Subject: caf\xe9\n\nbody\n", b"Subject: =?utf-8?q?caf=C3=A9?=\n\nbody\n"])
    rows = nested_body(header_projection(read(spark, path))).orderBy("msg_idx").collect()
    assert rows[0]["body"] == "ab\n"
    assert "not ASCII" in rows[1]["error"] and rows[1]["body"] is None
    assert rows[2]["subject"] == "=?utf-8?q?caf=C3=A9?="


def test_decode_utf8(spark):
    cases = [b"a\xffb", "é�".encode(), b"\xe2\x28\xa1", b"\xe2\x82a", b"\xed\xa0\x80x", b"", "😀".encode()]
    df = spark.createDataFrame([(c,) for c in cases], "payload binary")
    found = [r[0] for r in df.select(decode_utf8(F.col("payload"))).collect()]
    assert found == [c.decode("utf-8", errors="ignore") for c in cases]


def test_corpus_keeps_every_mailbox_apart(spark, tmp_path):
    words = "one two three four five six seven eight nine ten"
    for box in ("A", "B"):
        write(tmp_path / "in" / f"{box}.mbox" / "mbox", [single(f"{box}{i}", words) for i in range(5)] + [single("s", "short")])
    model = LanguageModel.fit(spark.createDataFrame([(words, "en"), ("een twee drie", "nl")], "text string, lang string"))
    stats = build_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), model).first()
    assert (stats["total"], stats["processed"], stats["skipped_short"]) == (12, 10, 2)
    corpus = read_examples(spark, str(tmp_path / "out"))
    assert {r[0].rsplit("-", 1)[0]: r[1] for r in corpus.groupBy("mailbox").count().collect()} == {"A": 5, "B": 5}
    names = spark.read.parquet(str(tmp_path / "out" / "_mailboxes")).collect()
    assert {r["source"].rsplit("/", 1)[-1] for r in names} == {"A.mbox", "B.mbox"}
    assert {r[0] for r in corpus.select("metadata.language").collect()} == {"en"}
    limited = build_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out2"), model, limit=2).first()
    assert (limited["total"], limited["processed"]) == (4, 4)


def test_long_paths_spaces_and_one_form_of_names(spark, tmp_path):
    words = "one two three four five six seven eight nine ten"
    box = tmp_path / ("long folder é+%" * 12) / "All mail.mbox"
    write(box, [single("one", words)])
    model = LanguageModel.fit(spark.createDataFrame([(words, "en")], "text string, lang string"))
    found = source.find_mailboxes(spark, str(tmp_path)).first()
    assert found["source"] == found["file"] == f"file:{box}"
    assert source.read_messages(spark, str(tmp_path)).first()["source"] == found["source"]
    assert build_corpus(spark, str(tmp_path), str(tmp_path / "out"), model).first()["processed"] == 1
    assert read_examples(spark, str(tmp_path / "out")).first()["mailbox"].startswith("All_mail-")


@pytest.mark.parametrize("name", ["_Sent.mbox", ".Sent.mbox/mbox", "_Archive.mbox/mbox"])
def test_mailboxes_that_spark_skips_are_an_error(spark, tmp_path, name):
    write(tmp_path / "in" / "a.mbox", [single("a", "b")])
    source.check_mailboxes(spark, str(tmp_path / "in"))
    write(tmp_path / "in" / name, [single("a", "b")])
    with pytest.raises(ValueError, match="Sent|Archive"):
        source.check_mailboxes(spark, str(tmp_path / "in"))


def test_no_mailbox_is_an_error(spark, tmp_path):
    (tmp_path / "x.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        source.check_mailboxes(spark, str(tmp_path))


def test_judging_is_one_projection(spark, tmp_path):
    model = LanguageModel.fit(spark.createDataFrame([("a b", "en")], "text string, lang string"))
    empty = spark.createDataFrame([], source.MESSAGE_SCHEMA)
    plan = judge_messages(empty, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_a_batch_of_any_size_is_parsed_in_small_ones(spark):
    schema = to_arrow_schema(spark.createDataFrame([], source.MESSAGE_SCHEMA).schema)
    raw = [b"From " * (i == 0) + b"a@example.com\nSubject: %d\n\nbody %d" % (i, i) + b"x" * (i % 7 * 10_000) for i in range(1_000)]
    n = len(raw)
    columns = [["file:/a.mbox"] * n, ["file:/a.mbox"] * n, [0] * n, [True] * n, raw]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["source", "file", "block_start", "last_block", "raw"])
    parsed = list(source._parser(schema, None)(iter([batch])))
    assert max(b.num_rows for b in parsed) <= source.PARSED_RECORDS
    assert max(b.nbytes for b in parsed) < 2 * source.PARSED_BYTES < batch.nbytes
    rows = [row for b in parsed for row in b.to_pylist()]
    assert [r["pos"] for r in rows] == list(range(n))
    assert [len(r["parts"][0]["payload"].rstrip()) for r in rows] == [len(f"body {i}") + i % 7 * 10_000 for i in range(n)]


LIMIT = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture
def batch_limit(spark):
    before = spark.conf.get(LIMIT, None)
    yield lambda value: spark.conf.set(LIMIT, value)
    if before is None:
        spark.conf.unset(LIMIT)
    else:
        spark.conf.set(LIMIT, before)


@pytest.mark.parametrize("run", ["stage", "build", "limited build", "update"])
def test_the_parser_gets_small_batches(spark, tmp_path, monkeypatch, run):
    words = "one two three four five six seven eight nine ten"
    n = 5 * source.RAW_RECORDS
    write(tmp_path / "in" / "a.mbox", [single(i, words) for i in range(n)])
    most, real = source.RAW_RECORDS, source._parser

    def checked(schema, limit):
        parse = real(schema, limit)

        def sized(batches):
            for batch in batches:
                if batch.num_rows > most:
                    raise ValueError(f"a batch of {batch.num_rows} records")
                yield batch

        return lambda batches: parse(sized(batches))

    monkeypatch.setattr(source, "_parser", checked)
    model = LanguageModel.fit(spark.createDataFrame([(words, "en")], "text string, lang string"))
    boxes, out, before = str(tmp_path / "in"), str(tmp_path / "out"), spark.conf.get(LIMIT)
    if run == "stage":
        assert source.with_message_index(source.stage_messages(spark, boxes, out)).count() == n
    elif run == "update":
        assert update_corpus(spark, boxes, out, model).first()["processed"] == n
    else:
        assert build_corpus(spark, boxes, out, model, limit=n - 1 if "limited" in run else None).first()["processed"] == n - ("limited" in run)
    assert spark.conf.get(LIMIT) == before and int(before) > most


@pytest.mark.parametrize("value, inside", [(None, "64"), ("0", "64"), ("-1", "64"), ("7", "7"), ("5000", "64")])
def test_the_batch_limit_is_put_back(spark, batch_limit, value, inside):
    if value is None:
        spark.conf.unset(LIMIT)
    else:
        batch_limit(value)
    with pytest.raises(RuntimeError), source.small_batches(spark):
        assert spark.conf.get(LIMIT) == inside
        with source.small_batches(spark):
            assert spark.conf.get(LIMIT) == inside
        assert spark.conf.get(LIMIT) == inside
        raise RuntimeError
    assert spark.conf.get(LIMIT, None) == value and not source._held
