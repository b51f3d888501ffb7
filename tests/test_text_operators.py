from __future__ import annotations

import math
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lettermill.functions import html
from lettermill.functions.html import html_to_text, wrap_lines
from lettermill.operators import chats, examples, language, reports, sequences, style
from lettermill.operators.language import LanguageModel
from lettermill.streaming.incremental import stream_examples, write_stream
from lettermill.plans import levels
from lettermill.views import emails, table

DATA = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- HTML -----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>a</p><p>b</p>", "a\n\nb"),
        ('<a class="x" href="http://e.com/?a=1&amp;b=2">text</a>', "[text](http://e.com/?a=1&b=2)"),
        ('a<img src="x.png">b', "ab"),
        ("<b>bold</b> <em>soft</em> <body>", "**bold** _soft_"),
        ("<head><title>t</title></head><style>p{}</style><script>x('</p>')</script>a<!-- c -->b", "ab"),
        ("&amp;lt;p&amp;gt; &lt;p&gt; &quot;q&#39;&nbsp;", "&lt;p&gt; <p> \"q'"),
        ("a<br>b<br/>c", "a\nb\nc"),
        ("a<blockquote><p>q</p><p>r</p></blockquote>b", "a\n> q\n> \n> r\nb"),
        ("<blockquote>q<blockquote>r</blockquote>s</blockquote>b", "> q\n> > r\n> s\nb"),
        ("a</blockquote>b", "a\nb"),
        ("caf&eacute; it&#8217;s &#x20AC;5 &hellip; &euro; &notanentity; &; a&b &#xD800; &#0;", "café it’s €5 … € &notanentity; &; a&b \ufffd \ufffd"),
        ("1 < 2 and 3 > 2 <3 a<b>c</b>", "1 < 2 and 3 > 2 <3 a**c**"),
        ("<p>one\n two\r\n\tthree</p>", "one two three"),
        ("<a href=http://e.com/x>t</a> <A HREF='q'>u</A> <a href=y>open <a name=z>n</a>", "[t](http://e.com/x) [u](q) [open n](y)"),
        ("<h1>Top</h1><h3 class=x>Sub</h3>t<ul><li>a<li>b</ul>c", "# Top\n\n### Sub\nt\n\n  * a\n  * b\nc"),
        ("a<pre>  x\n   y</pre>b <!-- c --> d --> e <!-- open", "a\nx\n   y\nb d --> e <!-- open"),
        ("<script>x<script>y</script>z<style>s", "zs"),
        ("&lt;b&gt; &amp;eacute;", "<b> &eacute;"),
    ],
)
def test_html_to_text(texts, html, expected):
    assert texts([html]).select(html_to_text(F.col("text"))).first()[0] == expected


@pytest.mark.parametrize("piece", ["<a href='x'>", "<!--", "<script>", "<b ", " ", "&", "&#", "<", "</a>", "\n ", "<li>", "<head>", "-->"])
def test_html_is_linear(texts, piece):
    import time

    df = texts([piece * (1_000_000 // len(piece))]).select(F.length(html_to_text(F.col("text"))))
    texts(["<p>a</p>"]).select(html_to_text(F.col("text"))).collect()
    start = time.perf_counter()
    df.collect()
    assert time.perf_counter() - start < 20


def test_wrapping_equals_the_standard_library(texts):
    import random
    import textwrap

    rng = random.Random(5)
    words = [("x" * rng.choice([1, 2, 5, 9, 77, 78, 79, 120])) for _ in range(3000)]
    lines = [" ".join(words[i : i + rng.randint(1, 40)]) for i in range(0, 3000, 20)]
    wrapped = texts(["\n".join(lines)]).select(wrap_lines(F.col("text"))).first()[0]
    expected = [w for line in lines for w in textwrap.wrap(line, 78, break_long_words=False)]
    assert wrapped.split("\n") == expected
    assert texts(["a\n\nb"]).select(wrap_lines(F.col("text"))).first()[0] == "a\n\nb"


# --- language ---------------------------------------------------------------------------


def test_language_model_learns_the_labels(spark):
    documents = table(spark, DATA, "documents")
    model = LanguageModel.fit(documents.filter("doc_id % 2 = 0"))
    others = model.with_language(documents.filter("doc_id % 2 = 1"), "text")
    assert others.filter("lang = lang_detected").count() / others.count() > 0.97
    assert all(len(v) == 16**language.HASH_DIGITS for v in model.scores.values())


def test_language_rules(spark, texts):
    labelled = [("the cat sat", "en"), ("de kat zat", "nl"), ("le chat", "fr")]
    model = LanguageModel.fit(spark.createDataFrame(labelled, "text string, lang string"))
    rows = model.with_language(texts(["the cat", "de kat", "le chat", "", "12 !!", "x" * 500 + " the"]), "text")
    mapped = rows.withColumn("language", language.map_language(F.col("lang_detected"))).orderBy("id").collect()
    assert [r["lang_detected"] for r in mapped] == ["en", "nl", "fr", "unknown", "unknown", "unknown"]
    assert [r["language"] for r in mapped] == ["en", "nl", "unknown", "unknown", "unknown", "unknown"]
    assert "Exchange" not in plan_of(model.with_language(spark.read.parquet(f"{DATA}/documents.parquet"), "text"))


def test_language_model_is_kept_and_bounded(spark, texts, tmp_path):
    rows = [("the cat", "en")] * 50 + [("de kat", "nl"), (None, "nl"), ("x", None)]
    model = LanguageModel.fit(spark.createDataFrame(rows, "text string, lang string"))
    model.save(spark, str(tmp_path / "model"))
    assert LanguageModel.load(spark, str(tmp_path / "model")) == model and set(model.scores) == {"en", "nl"}
    found = model.with_language(texts(["de kat", "the cat"]), "text", only=F.col("id") == 0).orderBy("id").collect()
    assert [r["lang_detected"] for r in found] == ["nl", None]
    for empty in ([], [("x", None)]):
        with pytest.raises(ValueError, match="no labelled"):
            LanguageModel.fit(spark.createDataFrame(empty, "text string, lang string"))


def test_language_model_counts_every_text(spark):
    rows = spark.range(30_000).select(F.concat(F.lit("the w"), F.col("id") % 7).alias("text"), F.lit("en").alias("lang"))
    expected = {r["bucket"]: r["score"] for r in language.bucket_profile(rows).collect()}
    scores = LanguageModel.fit(rows).scores["en"]
    assert {i: n for i, n in enumerate(scores) if n} == expected


def test_language_ties_go_to_the_first_name(spark, texts):
    model = LanguageModel.fit(spark.createDataFrame([("a", "nl"), ("a", "en")], "text string, lang string"))
    assert model.with_language(texts(["a"]), "text").first()["lang_detected"] == "en"


def test_language_flags_are_substrings(texts):
    flags = language.language_flags(F.lower("text"))
    rows = texts(["like", "GRAAG please", "x"]).select(*[c.alias(n) for n, c in flags.items()]).collect()
    assert [tuple(r) for r in rows] == [(True, False), (True, True), (False, False)]


# --- examples ---------------------------------------------------------------------------


def test_examples(spark):
    mail = spark.createDataFrame(
        [("S", "", "body", 1, "nl"), ("", "x@y", "body", 1, "nl")],
        "subject string, to_addr string, clean string, n_words int, language string",
    )
    users = [r["messages"][1]["content"] for r in examples.build_examples(mail).collect()]
    assert users == ["Write an email with subject: S", "Write an email with subject: \nTo: x@y"]
    messages = [("assistant", None), ("user", "u"), ("assistant", "b")]
    nested = spark.createDataFrame([(messages,)], "messages array<struct<role: string, content: string>>")
    assert [tuple(r) for r in examples.assistant_texts(nested).collect()] == [(0, ""), (2, "b")]


# --- style --------------------------------------------------------------------------------


def test_style_numbers(texts):
    df = texts(["Don't! Don't? I'm", "Regards, sincerely", "  ", "hey cool"])
    row = style.style_totals(df).first()
    assert (row["texts"], row["contractions"], row["formal"], row["casual"]) == (3, 3, 2, 2)
    assert (row["exclamations"], row["questions"], row["label"]) == (1, 1, "BALANCED")
    assert (row["min_words"], row["max_words"]) == (2, 3)
    assert math.isclose(row["avg_words"], 7 / 3)


@pytest.mark.parametrize("contractions, formal, label", [(3, 1, "CASUAL"), (2, 1, "BALANCED"), (1, 3, "FORMAL"), (0, 0, "BALANCED")])
def test_formality_label(spark, contractions, formal, label):
    assert spark.range(1).select(style.formality_label(F.lit(contractions), F.lit(formal))).first()[0] == label


def test_phrases(texts):
    df = texts(["Hoi\nx\nGroet", "Hoi\ny\nGroet", "Hi\nGroet", "zz"])
    assert [(r["phrase"], r["n"]) for r in style.top_openings(df).collect()] == [("Hoi", 2)]
    assert [(r["phrase"], r["n"]) for r in style.top_closings(df).collect()] == [("Groet", 3)]


def test_report_of_nothing(texts):
    rows = {r["item"]: r["value"] for r in style.style_report(texts(["", " "])).collect()}
    assert rows["texts"] == 0 and rows["avg_words"] is None and rows["BALANCED"] == 1


def test_report_is_the_same_for_any_partitioning(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    base = None
    for partitions in (1, 4, 64):
        rows = sorted(map(tuple, style.style_report(documents.repartition(partitions), "source").collect()))
        base = base or rows
        assert rows == base


def test_sample_is_reproducible(spark):
    documents = table(spark, DATA, "documents")
    first = [r["doc_id"] for r in style.sample_texts(documents, "doc_id").collect()]
    again = [r["doc_id"] for r in style.sample_texts(documents.repartition(7), "doc_id").collect()]
    assert first == again and len(set(first)) == 3 and max(first) < 100


# --- conversations and sequences -----------------------------------------------------------


def test_reply(texts):
    values = ["x Assistant y", "x assistant\n hi assistant yo ", "none", "assistant"]
    assert [r[0] for r in texts(values).select(chats.extract_reply(F.col("text"))).collect()] == ["x Assistant y", "yo", "none", ""]


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_text(spark):
    df = turns(spark, [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "user", None)])
    rows = {r["conv_id"]: r for r in chats.render_chat(df).collect()}
    assert rows[1]["chat"] == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n"
    assert rows[1]["chat_for_reply"].endswith("<|end|>\n<|assistant|>\n")
    assert rows[2]["chat"] == "<|user|>\n<|end|>\n"


def test_a_long_conversation_is_one_row(spark, monkeypatch):
    monkeypatch.setattr(levels, "FAN_IN", 4)
    numbers = [i * 7 for i in range(60)]
    df = turns(spark, [(1, i, "user" if i % 2 else None, str(i)) for i in reversed(numbers)] + [(2, 0, "user", "x"), (2, 5000, "user", "y")])
    rows = {r["conv_id"]: r for r in chats.nest_turns(df).collect()}
    assert [m["content"] for m in rows[1]["messages"]] == [str(i) for i in numbers]
    assert [m["content"] for m in rows[2]["messages"]] == ["x", "y"]
    texts = {r["conv_id"]: r for r in chats.render_chat(df).collect()}
    assert texts[1]["chat"] == "".join(f"<|{'user' if i % 2 else ''}|>\n{i}<|end|>\n" for i in numbers)
    assert texts[1]["chat_for_reply"] == texts[1]["chat"] + "<|assistant|>\n"


def test_template_by_role(spark):
    template = chats.ChatTemplate(begin="<s>", roles=(("user", "[I] ", " [/I]"), ("assistant", " ", "</s>")))
    df = turns(spark, [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")])
    row = chats.render_chat(df, template).first()
    assert row["chat"] == "<s><|system|>\ns<|end|>\n[I] u [/I] a</s>" and row["chat_for_reply"] == row["chat"] + " "


def test_sequences(texts, spark):
    first, byte = sequences.FIRST_ID, sequences.FIRST_BYTE_ID
    vocab = sequences.build_vocab(texts(["b b a", "c ü ü ü"]), size=3)
    assert [tuple(r) for r in vocab.orderBy("token_id").collect()] == [(" ü", 3, first), (" a", 1, first + 1), (" b", 1, first + 2)]
    rows = sequences.encode_sequences(texts(["a b", "", None, " ü ü é"]), vocab, "id", max_length=4).orderBy("id").collect()
    assert [r["input_ids"] for r in rows] == [[byte + 97, first + 2, 0, 0], [0] * 4, [0] * 4, [first, first, byte + 32, byte + 0xC3]]
    assert [r["attention_mask"] for r in rows] == [[1, 1, 0, 0], [0] * 4, [0] * 4, [1] * 4]
    assert all(r["labels"] == r["input_ids"] for r in rows)
    assert "Exchange" not in plan_of(sequences.encode_sequences(spark.read.parquet(f"{DATA}/documents.parquet"), vocab))
    given = ["a  b\n\tc é漢 <|end|> 😀_x", "", " ü", "\u00a0 ok"]
    decoded = sequences.decode_sequences(sequences.encode_ids(texts(given), vocab, "id"), vocab, "id").orderBy("id").collect()
    assert [r["text"] for r in decoded] == given


def test_encoding_turns_equals_encoding_the_rendered_chat(spark):
    df = table(spark, DATA, "conversations")
    vocab = sequences.build_vocab(df)
    whole = sequences.encode_sequences(chats.render_chat(df), vocab, "conv_id", text="chat", max_length=64)
    by_turn = sequences.encode_conversations(df, vocab, max_length=64)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, by_turn.collect()))


def test_encoding_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(levels, "FAN_IN", 4)
    df = turns(spark, [(c, i * i, "user", f"w{i} x") for c in (1, 2) for i in range(30)])
    vocab = sequences.build_vocab(df)
    whole = sequences.encode_sequences(chats.render_chat(df), vocab, "conv_id", text="chat", max_length=50)
    by_turn = sequences.encode_conversations(df, vocab, max_length=50)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, by_turn.collect()))


def test_budget(spark):
    row = reports.training_budget(spark.range(2700), [(2, 8, 1, 3), (2, 8, 2, 3)], 14).orderBy("workers").collect()
    assert [r["steps"] for r in row] == [504, 252]
    assert [round(r["hours"], 2) for r in row] == [1.96, 0.98]


def test_missing_responses_stay(spark):
    prompts = spark.createDataFrame([(1, "p"), (2, "q")], "id long, prompt string")
    responses = spark.createDataFrame([(1, "base", "x"), (1, "tuned", "y"), (2, "tuned", "z")], "id long, variant string, response string")
    rows = chats.compare_responses(prompts, responses, ["id"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "p", "x", "y"), (2, "q", None, "z")]
    with pytest.raises(Exception, match="more than one response"):
        chats.compare_responses(prompts, responses.union(responses), ["id"]).collect()


# --- plans and stream ---------------------------------------------------------------------------


def test_plans(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    report = plan_of(style.style_report(documents, "source"))
    assert "Python" not in report and "WindowGroupLimit" in report
    assert "TakeOrderedAndProject" in plan_of(style.top_words(documents))
    scan = plan_of(style.length_stats(documents, "source"))
    assert "ReadSchema: struct<text:string,source:string>" in scan


def test_stream_equals_batch(spark, tmp_path):
    mail = emails(spark, "/root/testdata/sf0.001")
    model = LanguageModel.fit(table(spark, "/root/testdata/sf0.001", "documents"))
    mail.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(mail.schema).parquet(str(tmp_path / "in"))
    query = write_stream(stream_examples(stream, model), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    batch = stream_examples(mail, model)
    written = spark.read.schema(batch.schema).json(str(tmp_path / "out"))
    assert sorted(map(str, written.collect())) == sorted(map(str, batch.collect()))


def _peak_of(use, *args):
    tracemalloc.start()
    try:
        return use(*args), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_token_lookup_needs_memory_for_a_slice_of_a_batch(texts):
    lookup = sequences.token_lookup(sequences.build_vocab(texts(["a b a b a", "é"]), size=2)).func
    rows = [["a", " b", " a", "é"] * 100, [], None, [" b"]] * 2_000
    batch = pa.array(rows, pa.list_(pa.string()))
    ids, peak = _peak_of(lookup, batch)
    assert ids[:4].to_pylist() == lookup(pa.array(rows[:4], pa.list_(pa.string()))).to_pylist()
    assert ids[4:].equals(ids[:-4]) and len(ids) == len(rows)
    assert peak < 10e6  # numbers of all 802,000 tokens at once: over 40 MB
    assert lookup(pa.array([], pa.list_(pa.string()))).equals(pa.array([], pa.list_(pa.int32())))


def test_token_decoder_needs_memory_for_a_slice_of_a_batch(texts):
    vocab = sequences.build_vocab(texts(["a b a b a", "é"]), size=2)
    ids = sequences.token_lookup(vocab).func(pa.array([["a", " b", " a", "é"] * 100, [], [" b"]] * 2_000, pa.list_(pa.string())))
    decoded, peak = _peak_of(sequences.token_decoder(vocab).func, ids)
    assert decoded.to_pylist() == ["a b aé" * 100, "", " b"] * 2_000
    assert peak < 4e6  # all ids as Python lists: over 8 MB


def test_html_without_an_end_is_not_searched_again(spark):
    page, end = F.col("page"), html.END
    pages = spark.createDataFrame([("a <!-- b",), ("a <!-- b --> c <!-- d",), ("a --> b",), ("",), (None,)], "page string")
    found = pages.select(html._without(page, "<!--", "-->", "-->").alias("t"))
    assert [r["t"] for r in found.collect()] == ["a <!-- b", "a  c <!-- d", "a --> b", "", None]
    assert "Contains(lambda" in plan_of(found) and end not in found.first()["t"]
