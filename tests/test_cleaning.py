from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lettermill import oracle
from lettermill.functions import cleaning
from lettermill.functions.text import count_substring, ellipsize, first_line, last_line, plain_words, strip, word_count
from lettermill.operators.filtering import with_status


def run(texts, values, function):
    rows = texts(values).select("id", function(F.col("text")).alias("out")).orderBy("id").collect()
    return [r["out"] for r in rows]


@pytest.mark.parametrize(
    "body, expected",
    [
        (None, ""),
        ("", ""),
        ("Hi\nKind regards", "Hi\nKind regards"),
        ("Thanks for the offer\nmore", ""),
        ("a\n\n \nMvg Jan\nx", "a"),
        ("Hi\nGroeten\n", "Hi"),
        ("text\nRegards!", "text\nRegards!"),
        ("Hi\nKind  regards, Jan", "Hi\nKind regards, Jan"),
        ("Hi\n/ Regards\nx", "Hi\n/ Regards\nx"),
        ("Hi\n  kind REGARDS/ Jan\nx", "Hi"),
        ("a\n---\nb", "a"),
        ("a\n-- \nb", "a"),
        ("a\n -- Jan\nb", "a"),
        ("a\n----\nb", "a\nb"),
        ("a\n___\nb", "a"),
        ("a\n****\n*****\nb", "a\n*****\nb"),
        ("a\n* *\n*    *\nb", "a\n* *\nb"),
        ("a\n_\nb", "a\nb"),
        ("  > x\ny", "y"),
        ("| x\ny", "y"),
        ("a\nMobile phones cost 5\nb", "a\nb"),
        ("a\ntel 06 (0)\nb", "a\nb"),
        ("a\nTel:\nb", "a\nTel:\nb"),
        ("a\nTelevision 5\nb", "a\nTelevision 5\nb"),
        ("a\nOn Monday Jan wrote:\nb", "a"),
        ("a\n on monday jan WROTE \nb", "a"),
        ("a\nOn Monday Jan wrote: this\nb", "a\nOn Monday Jan wrote: this\nb"),
        ("a\nOp ma schreef Piet:\nb", "a"),
        ("a\nOp ma schreef\nb", "a\nOp ma schreef\nb"),
        ("a\nOn 10 Feb 2023, at 11:49\nb", "a"),
        ("a\n\n\n\nb  c", "a\n\nb c"),
        ("a\n" + "x" * 500 + "\nb", "a\n" + "x" * 500 + "\nb"),
        ("a\n" + "x" * 501 + "\nb", "a\nb"),
        ("a\n" + "😀" * 500 + "\nb", "a\n" + "😀" * 500 + "\nb"),
        ("a\n > q\nb ", "a\nb"),
        ("\x1c a \x1f", "a"),
        ("Groet,\nJan", ""),
        ("Bedankt\tJan", ""),
        ("a\r\n> q\r\nb\r\n--\r\nc", "a\r\nb"),
    ],
)
def test_clean_text(texts, body, expected):
    assert run(texts, [body], cleaning.clean_text) == [expected]


def test_cut_keeps_the_line_feed_before_blank_lines(texts):
    values = ["a  \n\n \nMvg Jan\nx", " \n Mvg Jan", "a\nMvg Jan", "no cut\n\n"]
    assert run(texts, values, cleaning.cut_signature) == ["a  \n", "", "a\n", "no cut\n\n"]


def test_stops_and_drops_alone(texts):
    assert run(texts, ["a\n\n--\nb", "--", "a"], cleaning.stop_delimiter) == ["a\n", "", "a"]
    assert run(texts, ["> a", "> a\n", "a\n> b", ""], cleaning.drop_quoted) == ["", "", "a", ""]


def test_long_runs_of_blank_lines_are_linear(texts):
    body = "a" + "\n" * 200_000 + " " * 300 + "b" + " " * 100 + "c"
    assert run(texts, [body], cleaning.clean_text) == ["a\n\n b c"]


def test_random_texts_agree_with_sql(spark, tmp_path):
    """Lines made of the rules' own building blocks, in both engines."""
    pieces = [
        "Kind regards", "regards,", "Groeten", "mvg", "Thanks/", "> q", "|", "--", "---", "-- ", "___", "On", "Op", "x wrote:",
        "wrote", "schreef", "at 1:", "12", "***", "*", "_", "Tel", "Mob:", "+31", "(", " ", "  ", "word", "é", "a" * 501, "",
    ]
    rng = random.Random(7)

    def line():
        return " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 4)))

    bodies = ["\n".join(line() for _ in range(rng.randint(0, 8))) for _ in range(4000)]
    path = str(tmp_path / "bodies.parquet")
    spark.createDataFrame(list(enumerate(bodies)), "doc_id long, body string").write.parquet(path)
    ours = spark.read.parquet(path).select("doc_id", cleaning.clean_text(F.col("body")).alias("text"))
    sql = oracle._query("select doc_id, clean as text from cleaned", "cleaned", emails=f"select * from '{path}/*.parquet'")
    expected = dict(duckdb.sql(sql).fetchall())
    found = {r["doc_id"]: r["text"] for r in ours.collect()}
    assert len(found) == len(expected) == 4000
    wrong = [(bodies[i], found[i], expected[i]) for i in found if found[i] != expected[i]]
    assert wrong == []


def test_status(texts):
    nine, ten = "w " * 9, "w " * 10
    rows = with_status(texts(["", None, "   ", nine, ten, "> " + ten]), "text").orderBy("id").collect()
    assert [r["status"] for r in rows] == ["empty", "empty", "short", "short", "ok", "short"]


def test_error_status(spark):
    rows = spark.createDataFrame([("x", "boom"), ("", None)], "body string, error string")
    assert [r["status"] for r in with_status(rows).collect()] == ["error", "empty"]


def test_words(texts):
    values = ["", "  ", "a", " a b ", "a b c\x1cd", "a\n\nb\t c"]
    assert run(texts, values, word_count) == [len(v.split()) for v in values]
    assert run(texts, ["éaument abc", "abc_def abc1 xyz", "Don't STOP"], plain_words) == [["abc"], ["xyz"], ["don", "stop"]]
    assert run(texts, ["aaaaa", "", "baab"], lambda c: count_substring(c, "aa")) == [2, 0, 1]


def test_lines_and_display(texts):
    values = ["\n a \nb\n", "one", "a\n \n  z  \n\n"]
    assert run(texts, values, first_line) == ["a", "one", "a"]
    assert run(texts, values, last_line) == ["b", "one", "z"]
    assert run(texts, ["abcd", "abc"], lambda c: ellipsize(c, 3)) == ["abc...", "abc"]
    assert run(texts, ["　 a\x1d"], strip) == ["a"]
