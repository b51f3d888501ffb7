"""Every stage of the pipeline on a small table with known answers."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline as cp
from tests.llm.test_packing import FILES
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_substrings import plain

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(2)
    vocab = {"en": "the of and is that with from this", "de": "der die und das nicht mit auf ein"}
    rows = []
    for i in range(200):
        lang = rng.choice(["en", "de"])
        words = [rng.choice(vocab[lang].split()) + rng.choice(["", "a", "er", "x"]) for _ in range(rng.randrange(30, 80))]
        if i % 4 == 0:
            words[::9] = ["nasty"] * len(words[::9])
        rows.append((i, " ".join(words), lang, f"s{i % 3}", 0))
    passage = " ".join(f"shared{k}" for k in range(25))
    rows += [(300, rows[1][1], "en", "s1", 0), (301, "12 34 !!", "en", None, 0), (302, None, None, "s1", None), (303, "", "en", "s1", 0)]
    rows += [(310 + k, rows[5 + 2 * k][1] + "\n" + passage, "en", "s2", 0) for k in (0, 1)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs.collect()
    ids = lambda rows: {r["doc_id"] for r in rows}
    for name, stage in cp.STAGES:
        docs = cp.staged(stage(spark, docs, folder), name)
        after = docs.collect()
        if name != "packing":
            assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
        if name == "toxicity":
            assert ids(before) - ids(after) == {i for i in range(0, 200, 4)}
        if name == "language_id":
            assert ids(before) - ids(after) == {301, 302, 303}
        if name == "simhash":
            label = plain_components([r["doc_id"] for r in before], [plain_fingerprint(r["text"]) for r in before])
            assert ids(after) == {i for i, c in label.items() if i == c} and 300 not in ids(after)
        if name == "substring_dedup":
            expected = plain([(r["doc_id"], r["text"]) for r in before], 20)
            assert {r["doc_id"]: len(r["text"].split()) for r in after} == {i: n - gone for i, (n, gone, _) in expected.items()}
            assert all(r["n_chars"] == len(r["text"]) for r in after)
            assert sum(gone for _, gone, _ in expected.values()) > 0
        if name == "packing":
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(FILES[0])
            total = sum(len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in before)
            assert sum(r["length"] for r in after) == total and ids(after) == ids(before)
            assert len({r["sequence_id"] for r in after}) == -(-total // 2048)
        before = after


def test_run_and_empty_table(spark, folder, tmp_path):
    assert cp.run(spark, folder).count() > 0
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
