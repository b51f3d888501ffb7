"""Sign-offs that no list holds, learned from how the messages of an author end.

The last written lines of a message, read backwards, are a path in a trie of its
author. A node under which many different lines stand is a block that the author
puts below different messages: a sign-off. Copies of a message end alike and have the
same line above, so however many there are they count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.functions.text import rstrip, strip
from lettermill.plans.joins import checked_join
from lettermill.plans.parallelism import with_columns_once
from lettermill.session import staged

LINES = 12  # a sign-off has so many written lines, at most
LEAST = 5  # and stands below so many different lines, at least,
SHARE = 0.02  # and below this share of the different endings of the author


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _written(lines: Column) -> Column:
    """Places of the lines that are not blank, from 0."""
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    return F.filter(places, lambda i: strip(lines[i]) != "")


def _nodes(texts: DataFrame, author: str, text: str, lines: int) -> DataFrame:
    """``texts`` and ``_nodes``: depth, key and line above of every block that may end a message, from the last line up.

    Keys are 64-bit hashes of author and block. A block leaves at least one line of its message.
    """
    once = with_columns_once(texts, {"_lines": _lines(F.coalesce(F.col(text), F.lit("")))})
    once = with_columns_once(once, {"_written": _written(F.col("_lines"))})
    tail = F.reverse(F.slice(F.col("_written"), F.greatest(F.size("_written") - lines, F.lit(1)), F.lit(lines + 1)))
    once = with_columns_once(once, {"_tail": F.transform(tail, lambda i: strip(F.col("_lines")[i]))})
    depths = F.slice(F.sequence(F.lit(1), F.lit(lines)), F.lit(1), F.greatest(F.size("_tail") - 1, F.lit(0)))
    block = lambda d: F.array_join(F.slice("_tail", F.lit(1), d), "\n")
    nodes = F.transform(depths, lambda d: F.struct(
        d.alias("depth"), F.xxhash64(F.col(author), block(d)).alias("key"), F.xxhash64(F.col("_tail")[d]).alias("above")
    ))
    return with_columns_once(once, {"_nodes": nodes}).drop("_tail")


def sign_offs(
    texts: DataFrame, author: str, text: str = "text", lines: int = LINES, least: int = LEAST, share: float = SHARE
) -> DataFrame:
    """``(depth, key, below)``: the sign-offs of all authors, and below how many different lines each stands.

    Pairs of block and line above are made different first, with a partial step before the
    shuffle, then counted; so neither an author with most of the messages nor a block under most of them meets in one task.
    """
    nodes = _nodes(texts.select(author, text), author, text, lines)
    return _frequent(nodes.select(F.xxhash64(author).alias("author"), F.inline("_nodes")), least, share)


def _frequent(nodes: DataFrame, least: int, share: float) -> DataFrame:
    pairs = nodes.distinct()
    counted = staged(pairs.groupBy("author", "depth", "key").agg(F.count(F.lit(1)).alias("below")), "blocks")
    endings = counted.filter("depth = 1").groupBy("author").agg(F.sum("below").alias("endings"))
    found = checked_join(counted.filter(F.col("below") >= least), endings, "author", "inner")
    return found.filter(F.col("below") >= share * F.col("endings")).select("depth", "key", "below")


def cut_sign_offs(
    texts: DataFrame, author: str, text: str = "text", lines: int = LINES, least: int = LEAST, share: float = SHARE
) -> DataFrame:
    """``texts`` with the longest sign-off cut off every ``text``, and ``sign_off_lines``, the written lines that went.

    White space before the block goes with it. Texts without one stay as they are, null
    ones too; no message is cut whole. Lines are compared without the white space round them,
    blank ones do not count. Null is an author like any other. Equal rows are cut alike;
    a column named ``sign_off_lines`` is replaced, names that begin with an underscore are taken.
    """
    names = [c for c in texts.columns if c != "sign_off_lines"]
    found = staged(sign_offs(texts, author, text, lines, least, share).select("depth", "key"), "sign-offs")
    nodes = _nodes(texts.select(author, text), author, text, lines).filter(F.size("_nodes") > 0)
    last = lambda nodes: F.element_at(nodes, -1)["key"]
    ends = nodes.select(last(F.col("_nodes")).alias("_end"), "_nodes").dropDuplicates(["_end"])
    ends = ends.select("_end", F.inline("_nodes")).select("_end", "depth", "key")
    deepest = staged(checked_join(ends, found, ["depth", "key"], "inner").groupBy("_end").agg(F.max("depth").alias("_depth")), "ends")
    rows = _nodes(texts.select(*names), author, text, lines)
    rows = rows.withColumn("_end", F.when(F.size("_nodes") > 0, last(F.col("_nodes")))).drop("_nodes")
    first = F.element_at("_written", -F.col("_depth"))
    kept = rstrip(F.array_join(F.slice("_lines", F.lit(1), first), "\n"))
    cut = F.when(F.col("_depth").isNull(), F.col(text)).otherwise(kept)
    gone = F.coalesce(F.col("_depth"), F.lit(0)).alias("sign_off_lines")
    return checked_join(rows, deepest, "_end", "left").select(*[cut.alias(c) if c == text else c for c in names], gone)
