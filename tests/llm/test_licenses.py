"""Licence scan against SQL and against hand-written rows."""

from __future__ import annotations

import random
import re

from lettermill.llm import licenses as li
from lettermill.llm.queries import ORACLE, QUERIES
from tests.compare import compare, duck


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    assert compare(spark, duck(d), d, QUERIES["op6_licenses"], ORACLE["op6_licenses"]) == []


ROWS = [
    (1, "All rights reserved. CC BY, cc-by! all  RIGHTS\nreserved"), (2, None), (3, ""), (4, "...\n"), (5, "cc bys xcc by"),
    (6, "a GNU general public license"), (7, "Licensed under the Apache License, Version 2.0."), (8, "licensed apache under version the 2 license"),
    (9, "Released under the MIT."), (10, "été cc by ü"), (11, "x\nReleased under\nthe MIT License."), (None, "cc by"), (12, "cc by"), (12, "cc by"),
    (13, "# x\n#\n# Permission is hereby granted, free\n# of charge, to any person obtaining\n# a copy of this software\n# and associated documentation files\n#\n# y"),
    (14, "Released under\n\nthe MIT License."), (15, "Copyright\n * * *\nAll rights"), (16, "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC\nLICENSE VERSION 3"),
    (17, "This wor\u212a is licensed GNU general, version 3."), (18, "\u0130 cc by"),
]


def test_hand_written_rows(spark):
    df = spark.createDataFrame([(i, t, "z") for i, t in ROWS], "doc_id long, text string, doc string")
    got = {r["doc_id"]: tuple(r)[1:] for r in li.scan(df).collect()}
    assert got[1] == (10, 4, 0, 7, "cc-by,reserved", "cc-by,reserved", 1.0)
    assert got[2] == got[3] == got[4] == (0, 0, None, None, "", "", 0.0)
    assert got[5] == (4, 0, None, None, "", "", 0.0)
    assert got[6] == (5, 1, 2, 2, "gpl", "gpl", 1.0)
    assert got[7] == (8, 0, None, None, "", "apache", 1.0)
    assert got[8] == (7, 0, None, None, "", "apache", 0.875)
    assert got[9][5] == got[14][5] == got[15][5] == "" and got[11] == (6, 0, None, None, "", "mit", 1.0)
    assert got[13][5:] == ("mit", 1.0) and got[16][5] == "gpl" and got[17] == (8, 0, None, None, "", "", 0.0)
    assert got[18] == (3, 1, 1, 1, "cc-by", "cc-by", 1.0)
    assert got[10] == (4, 1, 1, 1, "cc-by", "cc-by", 1.0)
    assert got[12] == got[None] == (2, 1, 0, 0, "cc-by", "cc-by", 1.0)
    assert li.scan(df).count() == len(ROWS) and li.scan(df.limit(0)).count() == 0


def test_join_finds_exactly_the_blocks_above_the_threshold(spark):
    rng = random.Random(1)
    pool = sorted({w for ws in li.template_words(li.TEMPLATES) for w in ws}) + [f"w{i}" for i in range(20)]
    docs = []
    for i in range(150):
        lines = []
        for _ in range(rng.randrange(4)):
            words = list(rng.choice(li.template_words(li.TEMPLATES)))
            words = [w for w in words if rng.random() < 0.93] + rng.choices(pool, k=rng.randrange(6))
            rng.shuffle(words)
            lines.append(" ".join(words))
        docs.append((i, rng.choice(["\n\n", "\n - \n", "\n"]).join(lines)))
    got = {(r["doc"], r["block"], r["template"]) for r in li.similar_blocks(spark.createDataFrame(docs, "doc_id long, text string"), li.TEMPLATES).collect()}
    expected = set()
    for i, text in docs:
        for k, block in enumerate(re.split(li.PARAGRAPH_END, text)):
            have = set(re.split(li.SEPARATORS, block.lower()))
            for t, words in enumerate(li.template_words(li.TEMPLATES)):
                if len(have & set(words)) >= li.CONTAINMENT * len(words) - 1e-9:
                    expected.add((i, k, t))
    assert got == expected and len(got) > 30


def test_wrapped_notices_equal_sql(spark, tmp_path):
    """A notice wrapped in every way, against the SQL."""
    texts = [t for _, t in ROWS] + [re.sub(" ", rng, t) for _, t in li.TEMPLATES for rng in ("\n", " \n// ", "\n\n")]
    rows = [(i, t) for i, t in enumerate(texts)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    assert compare(spark, con, str(tmp_path), QUERIES["op6_licenses"], ORACLE["op6_licenses"]) == []
    assert sum(r["labels"] != "" for r in li.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()) >= 2 * len(li.TEMPLATES)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = li.scan(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
