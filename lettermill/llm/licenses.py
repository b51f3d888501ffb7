"""Licence notices: phrases by place, and templates by an exact set-similarity join. Built-in functions only."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.session import staged

CONTAINMENT = 0.85  # share of a template's words that a block of text must hold
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLANK = SEPARATORS.removesuffix("+") + "*"
PARAGRAPH_END = f"\n{BLANK}\n"  # lines without a word part paragraphs

# Phrases with their labels, and public licence notices with theirs.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("reserved", "Copyright. All rights reserved."),
]


def lowered(text: Column) -> Column:
    """Text with A-Z in lower case, and nothing else made ASCII; null is empty.

    Of all other characters only two have ASCII letters in their lower case;
    they are put aside first. Other scripts never count, so their case does not matter.
    """
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\u0130"), F.lit("\u0131"))
    return F.lower(F.replace(text, F.lit("\u212A"), F.lit("\u0138")))


def spaced(text: Column) -> Column:
    """Lower-cased words joined by single spaces; empty for null or wordless texts."""
    return F.trim(F.regexp_replace(lowered(text), SEPARATORS, " "))


def n_words(words: Column) -> Column:
    """Number of words of a text that ``spaced`` gave."""
    return F.when(words == "", F.lit(0)).otherwise(F.length(words) - F.length(F.replace(words, F.lit(" "))) + 1).cast("long")


def template_words(templates: list[tuple[str, str]]) -> list[list[str]]:
    import re

    return [sorted(set(filter(None, re.split(SEPARATORS, text.lower())))) for _, text in templates]


def phrase_places(docs: DataFrame, phrases: dict[str, str], text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_base``, ``first_word``, ``last_word`` and ``_base``, the labels found.

    Only texts that hold a phrase are cut at its places; the number of words
    before the first and behind the last piece gives the places.
    """
    out = docs.withColumn("_w", spaced(F.col(text_col)))
    out = out.select(*[c for c in docs.columns if c != text_col], F.concat(F.lit(" "), "_w", F.lit(" ")).alias("_p"), n_words(F.col("_w")).alias("n_words"))
    counts, firsts, lasts, labels = [], [], [], []
    inside = lambda piece: F.length(piece) - F.length(F.replace(piece, F.lit(" "))) - 1  # noqa: E731  words of " a b "
    for i, (phrase, label) in enumerate(phrases.items()):
        held = F.contains("_p", F.lit(f" {phrase} "))
        out = out.withColumn(f"_s{i}", F.when(held, F.split("_p", f"(?<= ){phrase}(?= )")))
        pieces = F.col(f"_s{i}")
        counts.append(F.coalesce(F.size(pieces) - 1, F.lit(0)))
        firsts.append(F.when(pieces.isNotNull(), inside(pieces[0])))
        lasts.append(F.when(pieces.isNotNull(), F.col("n_words") - inside(F.element_at(pieces, -1)) - len(phrase.split())))
        labels.append(F.when(pieces.isNotNull(), F.lit(label)))
    size = lambda x: F.when(x >= 0, x).otherwise(F.lit(0))
    total = sum((size(c) for c in counts), F.lit(0))
    return out.select(
        *[c for c in docs.columns if c != text_col], "n_words", total.cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("_base"),
    )


def similar_blocks(
    docs: DataFrame, templates: list[tuple[str, str]], containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc, block, template, label, share)`` of every block that holds at least ``containment`` of a template's words.

    A block is a paragraph, a run of lines with words in them; so a notice is
    found however it is wrapped, also behind comment marks, and a single line in
    it counts as well. Words are ordered by the number of blocks that hold them,
    rarest first. A block that shares enough words with a template shares one of
    its first ``words - needed + 1``; only these are joined. Blocks with fewer template
    words than needed, and pairs whose place in the order leaves too few words
    behind it, are dropped before the sets are compared. Words outside all
    templates never count, so blocks are kept as their template words alone, and
    all tables that are broadcast have the size of the templates.
    """
    spark = docs.sparkSession
    words = template_words(templates)
    vocabulary = sorted({w for ws in words for w in ws})
    needed = [ceil(containment * len(ws) - 1e-9) for ws in words]
    known = F.array(*[F.lit(w) for w in vocabulary])
    paragraphs = F.split(lowered(F.col(text_col)), PARAGRAPH_END)
    cut = docs.select(F.col(id_col).alias("doc"), F.posexplode(paragraphs).alias("block", "t"))
    blocks = staged(
        cut.select("doc", "block", F.array_intersect(F.split("t", SEPARATORS), known).alias("words")).filter(F.size("words") > 0),
        "licence-blocks",
    )
    counts = dict(blocks.select(F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1))).collect())  # one row a template word
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    index = [
        (w, t, i, len(ws), needed[t], templates[t][0], ws)
        for t, ws in enumerate(sorted(ws, key=order.get) for ws in words)
        for i, w in enumerate(ws[: len(ws) - needed[t] + 1])
    ]
    prefixes = spark.createDataFrame(index, "w string, template int, i int, n int, needed int, label string, set array<string>")
    ranks = F.create_map(*[F.lit(x) for w, i in order.items() for x in (w, i)])
    first = F.array(*[F.lit(w) for w in sorted({row[0] for row in index})])
    sorted_words = F.array_sort(F.transform("words", lambda w: F.struct(F.element_at(ranks, w).alias("r"), w.alias("w"))))
    candidates = (
        blocks.filter((F.size("words") >= min(needed, default=1)) & F.arrays_overlap("words", first))
        .select("doc", "block", "words", F.posexplode(sorted_words).alias("j", "x"))
        .select("doc", "block", "words", "j", F.col("x.w").alias("w"))
        .join(F.broadcast(prefixes), "w")
        .filter(F.size("words") >= F.col("needed"))
        .filter(1 + F.least(F.col("n") - 1 - F.col("i"), F.size("words") - 1 - F.col("j")) >= F.col("needed"))
    )
    share = F.size(F.array_intersect("words", "set")) / F.col("n")
    return (
        candidates.select("doc", "block", "template", "label", share.alias("share"), "n", "needed")
        .filter(F.round(F.col("share") * F.col("n")) >= F.col("needed"))
        .select("doc", "block", "template", "label", "share")
        .distinct()
    )


def scan(docs: DataFrame, containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of every row.

    ``base_*`` and the places are those of ``PHRASES``; ``labels`` adds those of
    similar paragraphs. The score is 1 where a phrase stands, else the largest share
    of a template in a paragraph that reaches ``containment``, else 0. Null and
    empty texts have no words, null places and empty labels. Repeated rows stay;
    rows of one id (or of none) share the labels of their paragraphs. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    base = phrase_places(rows, PHRASES)
    similar = similar_blocks(rows, TEMPLATES, containment, "doc_id").groupBy("doc").agg(
        F.collect_set("label").alias("_more"), F.max("share").alias("_share")  # as many as templates at most
    )
    none = F.array().cast("array<string>")
    joined = base.join(similar, F.col("doc_id").eqNullSafe(F.col("doc")), "left")
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", text(F.col("_base")).alias("base_labels"),
        text(F.concat("_base", F.coalesce("_more", none))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_share", F.lit(0.0))).alias("score"),
    )
