"""Learned sign-offs against a plain trie, and planted ones."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from lettermill.operators.signoffs import cut_sign_offs

SCHEMA = "id long, author string, text string"


def plain(rows, lines, least, share):
    above = defaultdict(set)
    tails = []
    for _, author, text in rows:
        tail = [line.strip() for line in (text or "").split("\n") if line.strip()][::-1]
        tails.append(tail)
        for d in range(1, min(lines, len(tail) - 1) + 1):
            above[author, tuple(tail[:d])].add(tail[d])
    endings = defaultdict(int)
    for (author, block), found in above.items():
        endings[author] += len(found) if len(block) == 1 else 0
    out = []
    for (i, author, text), tail in zip(rows, tails):
        depth = 0
        for d in range(1, min(lines, len(tail) - 1) + 1):
            n = len(above[author, tuple(tail[:d])])
            if n >= least and n >= share * endings[author]:
                depth = d
        if depth:
            all_lines = text.split("\n")
            first = [k for k, line in enumerate(all_lines) if line.strip()][-depth]
            text = "\n".join(all_lines[:first]).rstrip()
        out.append((i, text, depth))
    return sorted(out, key=repr)


def messages(seed, n):
    rng = random.Random(seed)
    blocks = ["Yours,\nAnn", "Yours,\n\n  Ann  \nSales é", "Ann", "ship it"]
    rows = []
    for i in range(n):
        body = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 4))) for _ in range(rng.randrange(0, 5))]
        text = "\n".join(body) + rng.choice(["\n", "\n\n", "\n \t\n", ""]) + rng.choice([*blocks, "", rng.choice("abc")])
        rows.append((i, rng.choice(["x", "x", "x", "y", "", None]), text + rng.choice(["", "\n", "  \n\n"])))
    return rows + [(n, "x", None), (n + 1, "x", ""), (n + 2, "x", "\n\n"), (n + 3, None, "Ann"), (n + 4, "x", "long " * 50_000 + "\nAnn")]


@pytest.mark.parametrize("lines, least, share", [(1, 2, 0.0), (3, 3, 0.05), (12, 5, 0.02), (12, 2, 0.3)])
def test_equals_plain_trie(spark, lines, least, share):
    rows = messages(lines * 10 + least, 400)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = cut_sign_offs(df, "author", "text", lines, least, share)
    assert got.columns == ["id", "author", "text", "sign_off_lines"]
    assert sorted(((r["id"], r["text"], r["sign_off_lines"]) for r in got.collect()), key=repr) == plain(rows, lines, least, share)


def test_planted_block_goes_and_copies_do_not_make_one(spark):
    planted = [(i, "a", f"Message {i}.\nIt has two lines, {i * 7}.\n\nCheers from the coast\nBo\nBoat Works") for i in range(30)]
    copies = [(100 + i, "b", "The same news\nfor all of you\nas every week") for i in range(300)]
    clean = [(500 + i, "a", f"Only text {i}\nand an end of its own, {i}") for i in range(30)]
    df = spark.createDataFrame(planted + copies + clean, SCHEMA).repartition(4)
    got = {r["id"]: (r["text"], r["sign_off_lines"]) for r in cut_sign_offs(df, "author").collect()}
    assert all(got[i] == (f"Message {i}.\nIt has two lines, {i * 7}.", 3) for i, _, _ in planted)
    assert all(got[i] == (t, 0) for i, _, t in copies + clean)


def test_empty_table_and_clashing_names(spark):
    assert cut_sign_offs(spark.createDataFrame([], SCHEMA), "author").count() == 0
    rows = [(i, "a", f"m{i}\nBo", 9, "z", 1) for i in range(6)] * 2
    df = spark.createDataFrame(rows, SCHEMA + ", sign_off_lines int, key string, depth int")
    got = cut_sign_offs(df, "author").collect()
    assert len(got) == 12 and {(r["text"], r["sign_off_lines"], r["key"]) for r in got} == {(f"m{i}", 1, "z") for i in range(6)}
