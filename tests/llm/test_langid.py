"""Language identification against the formulas, and accuracy on rows that were not learned from."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest

from lettermill.llm import langid

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    return langid.fit_text_model(docs.filter("doc_id % 2 = 0"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{D}/documents.parquet").filter("doc_id % 2 = 1")
    got = {r["doc_id"]: r["lang"] for r in langid.identify_documents(docs, model).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert sum(got[i] == l for i, l in truth.items()) >= 0.98 * len(truth)


def test_query_has_every_page_and_document(spark):
    from lettermill.llm.queries import QUERIES

    rows = QUERIES["op3_langid"](spark, "/root/testdata/sf0.001").collect()
    ids = lambda name: sorted(r[0] for r in spark.read.parquet(f"/root/testdata/sf0.001/{name[:-3]}s.parquet").select(name).collect())
    assert sorted(r["page_id"] for r in rows if r["doc_id"] is None) == ids("page_id")
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang").collect()
    found = {r["doc_id"]: r["lang"] for r in rows if r["page_id"] is None}
    assert sum(found[r["doc_id"]] == r["lang"] for r in documents) >= 0.98 * len(documents)


def test_windows_by_hand():
    texts = ["Ab1c", "", "é", "xyz"]
    column = pa.array(texts)
    rows, buckets = langid.window_buckets(*langid.text_bytes(column))
    expected = []
    for row, text in enumerate(texts):
        data = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in text.encode())
        padded = b"  " + data + b" "
        for i, b in enumerate(data):
            if b != 32:
                code = int.from_bytes(padded[i : i + 4], "little")
                expected.append((row, (code * 2654435761 % 2**32) >> 16))
    assert list(zip(rows.tolist(), buckets.tolist())) == expected


def plain_fuse(rows, languages):
    n, k = len(languages), langid.PSEUDO_PAGES
    told = [r for r in rows if r["n_letters"] > 0]
    group = lambda key, value: np.sum([r["p"] for r in told if r[key] == value] or [[0.0] * n], axis=0)
    total = np.sum([r["p"] for r in told] or [[0.0] * n], axis=0)
    prior = (total + k / n) / (total.sum() + k)
    out = {}
    for r in rows:
        own = np.array(r["p"]) if r["n_letters"] > 0 else np.zeros(n)
        counts = {key: group(key, r[key]) for key in ("host", "domain", "declared", "suffix")}
        domain = np.maximum(counts["domain"] - own, 0)
        domain = (domain + k * prior) / (domain.sum() + k)
        host = np.maximum((counts["host"] if r["host"] is not None else 0 * own) - own, 0)
        host = (host + k * domain) / (host.sum() + k)
        fused = np.array(r["logits"]) + np.log(host)
        for key in ("declared", "suffix"):
            share = (counts[key].sum() + 1) / (total.sum() + 1)
            fused += np.log((counts[key] + k * share) / (total + k))
        best = fused.argmax()
        out[r["id"]] = ("und", 0.0) if not r["n_letters"] else (languages[best], 1 / np.exp(fused - fused.max()).sum())
    return out


PAGES = [
    (1, "http://a.example.de/x", "<html lang='de-AT'><p>der und die &amp; das</p>"),
    (2, "http://a.example.de/y", "<html><p>der</p>"),
    (3, "https://b.example.de:80", "<p>la"),
    (4, None, None),
    (5, "", ""),
    (6, "/relative", "<HTML LANG=xx><script>der der</script>the of and"),
    (7, "HTTP://user@C.org?q", "<html lang=\"fr\"><!-- the"),
    (8, "//c.org/z", "<html lang='en'>the &eacute; 1 < 2"),
    (8, "//c.org/z", "<html lang='en'>the &eacute; 1 < 2"),
]


def test_fusion_equals_the_formulas(spark, model):
    df = spark.createDataFrame([(*p, "k") for p in PAGES], "page_id long, url string, html string, host string")
    rows = [r.asDict() for r in langid.page_evidence(df, model).collect()]
    assert {r["id"]: (r["host"], r["domain"], r["suffix"], r["declared"]) for r in rows} == {
        1: ("a.example.de", "example.de", "de", "de"), 2: ("a.example.de", "example.de", "de", "none"),
        3: ("b.example.de", "example.de", "de", "none"), 4: (None, "none", "none", "none"), 5: (None, "none", "none", "none"),
        6: (None, "none", "none", "other"), 7: ("c.org", "c.org", "org", "fr"), 8: ("c.org", "c.org", "org", "en"),
    }
    expected = plain_fuse(rows, model.languages)
    got = langid.identify_pages(df, model).collect()
    assert len(got) == len(PAGES)
    for r in got:
        lang, posterior = expected[r["page_id"]]
        assert r["lang"] == lang and math.isclose(r["posterior"], posterior, rel_tol=1e-9)
    assert {r["page_id"] for r in got if r["lang"] == "und"} == {4, 5, 7}


def test_declared_language_behind_a_long_comment(spark, model):
    page = "<!-- " + "licence " * 2000 + "-->\n<html lang='de'><p>der"
    pages = [page, "<html " * 50_000 + "lang=de", "<html " + "a " * 300_000 + "lang=de>"]
    df = spark.createDataFrame([(i, None, p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    assert [r["declared"] for r in langid.page_evidence(df, model).collect()] == ["de"] * 3


def test_html_text_is_linear_and_keeps_text():
    assert langid.html_text(b"a<b>c</b>&lt;1 < 2 <script>x</script><!-- y").split() == [b"a", b"c", b"<1", b"<", b"2"]
    for piece in (b"<!--", b"<script>", b"<a "):
        langid.html_text(piece * 50_000)


def test_no_rows_and_few_or_many_languages(spark, model, monkeypatch):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert langid.identify_pages(none, model).count() == 0
    schema = "doc_id long, text string, lang string, source string"
    cases = {None: ("und", 0.0), "en": ("en", 1.0)}
    for language, expected in cases.items():
        marked = spark.createDataFrame([(1, "some text", language, "s")] if language else [(1, None, "de", "s"), (2, "x", None, None)], schema)
        found = langid.fit_text_model(marked)
        docs = spark.createDataFrame([(5, "other words", None, "s"), (6, "12", None, None), (7, None, None, None)], schema)
        got = {r["doc_id"]: (r["lang"], r["posterior"]) for r in langid.identify_documents(docs, found).collect()}
        assert got == {5: expected, 6: ("und", 0.0), 7: ("und", 0.0)}
        assert langid.identify_documents(docs.limit(0), found).count() == 0
    assert langid.fit_text_model(spark.createDataFrame([], schema)).languages == ["und"]
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    many = spark.createDataFrame([(i, f"text {i}", f"l{min(i, 5)}", "s") for i in range(9)], schema)
    assert langid.fit_text_model(many).languages == ["l0", "l1", "l5"]


def test_query_on_an_empty_table(spark, tmp_path):
    from lettermill.llm.queries import QUERIES

    spark.createDataFrame([], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "http://a.de/", "<p>x")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert [(r["page_id"], r["lang"], r["posterior"]) for r in QUERIES["op3_langid"](spark, str(tmp_path)).collect()] == [(1, "und", 0.0)]
