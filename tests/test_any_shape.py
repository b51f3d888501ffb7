"""Examples of unknown shape keep what they hold."""

from __future__ import annotations

import json

from lettermill.sources import jsonl

GOOD = [
    {"messages": [{"role": "user", "content": "é \"q\"\n"}, {"role": "assistant", "content": "b", "weight": 0.5}], "id": 7, "tags": ["x", None, {"y": [1, 2.5, 10**20]}]},
    {"messages": [{"role": "user", "content": "only"}]},
    {"metadata": {"language": "nl", "word_count": 3, "subject": "s", "more": {"deep": True}}, "messages": []},
    {"metadata": {"language": 5, "word_count": "many"}, "messages": [{"role": "user"}, {"content": None, "role": "x"}, 4]},
    {"messages": [], "metadata": None, "": "", "a.b": 1},
]
BAD = ['{"messages": [', "not json", "3", "[]", '{"messages": 4}', '{"text": "x"}', '{"messages": [], "messages": []}', "null"]


def read(spark, tmp_path, lines):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return jsonl.read_any_shape(spark, str(tmp_path / "in"))


def test_round_trip_keeps_unknown_keys_and_rejects_bad_lines(spark, tmp_path):
    lines = [json.dumps(g, ensure_ascii=False) for g in GOOD] + BAD + ["", "  "]
    examples = read(spark, tmp_path, lines)
    assert sorted(r["_corrupt_record"] for r in examples.filter("value is null").collect()) == sorted(BAD)
    jsonl.write_any_shape(examples, str(tmp_path / "out"))
    again = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    key = lambda g: json.dumps(g, sort_keys=True)
    assert sorted(map(key, again)) == sorted(map(key, GOOD))
    twice = jsonl.read_any_shape(spark, str(tmp_path / "out"))
    assert twice.filter("value is null").count() == 0 and twice.count() == len(GOOD)


def test_known_fields_are_null_where_a_line_lacks_them(spark, tmp_path):
    rows = jsonl.known_fields(read(spark, tmp_path, [json.dumps(g) for g in GOOD])).collect()
    by = lambda n: rows[n]
    assert [tuple(m) for m in by(0)["messages"]] == [("user", 'é "q"\n'), ("assistant", "b")] and by(0)["metadata"] is None
    assert tuple(by(2)["metadata"]) == ("nl", 3, "s") and by(2)["messages"] == []
    assert tuple(by(3)["metadata"])[1:] == (None, None)
    assert [m and tuple(m) for m in by(3)["messages"]] == [("user", None), ("x", None), None]
    assert by(4)["metadata"] is None


def test_no_lines(spark, tmp_path):
    assert jsonl.known_fields(read(spark, tmp_path, [""])).count() == 0
