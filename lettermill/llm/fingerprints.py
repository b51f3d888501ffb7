"""Document fingerprints as invertible Bloom lookup sketches of paragraphs. Built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.session import staged

ROW_CELLS = 6  # cells of a sub-table; a digest is in one cell of each
ROWS = 3
PEEL_STEPS = 8
PARAGRAPH = 120  # a line goes on as a new paragraph at the first sentence end behind so many characters
SPLIT = 8  # digests per part of a larger sketch, about
MAX_SPLIT = 64  # parts per retry; parts that fail are split again
BUCKET_DOCS = 1_024
EDGES = 1_024  # ranges of a level, at most
ACCURACY = 20_000  # a quantile of ids is off by one in so many rows, at most
MASK = 0x7FFFFFFF


def paragraphs(text: Column) -> Column:
    """Digests of the different paragraphs of a text, none for an empty one."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"[^\n]{{{PARAGRAPH},}}?[.!?](?= |\n|$)|[^\n]+"), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(p)))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _entry(d: Column, sign: Column, level: int) -> Column:
    """A digest with its check value and its cell in every sub-table."""
    place = F.xxhash64(d, F.lit(level))
    cells = [(F.pmod(F.shiftright(place, 20 * j), F.lit(ROW_CELLS)) + j * ROW_CELLS).cast("int").alias(f"c{j}") for j in range(ROWS)]
    return F.struct(d.alias("d"), sign.cast("int").alias("s"), _check(d).alias("h"), *cells)


def _check(d: Column) -> Column:
    return F.xxhash64(d, F.lit(-1)).bitwiseAND(F.lit(MASK)).cast("int")


def _in_cell(entry: Column, i: Column) -> Column:
    return (entry["c0"] == i) | (entry["c1"] == i) | (entry["c2"] == i)


def sketch(digests: Column, level: int = 0) -> Column:
    """Cells ``(i, n, d, h)``: number, digests and check values of what fell into each, combined by exclusive or."""
    entries = F.transform(digests, lambda d: _entry(d, F.lit(1), level))
    empty = lambda i: F.struct(i.alias("i"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("d"), F.lit(0).alias("h"))
    return _let(entries, lambda es: F.transform(
        F.sequence(F.lit(0), F.lit(ROWS * ROW_CELLS - 1)),
        lambda i: F.aggregate(F.filter(es, lambda e: _in_cell(e, i)), empty(i), _add),
    ))


def _add(cell: Column, entry: Column) -> Column:
    return F.struct(
        cell["i"].alias("i"), (cell["n"] + entry["s"]).alias("n"),
        cell["d"].bitwiseXOR(entry["d"]).alias("d"), cell["h"].bitwiseXOR(entry["h"]).alias("h"),
    )


def subtract(left: Column, right: Column) -> Column:
    """Sketch of what only one side holds; +1 for the left side."""
    return F.zip_with(left, right, lambda a, b: F.struct(
        a["i"].alias("i"), (a["n"] - b["n"]).alias("n"), a["d"].bitwiseXOR(b["d"]).alias("d"), a["h"].bitwiseXOR(b["h"]).alias("h")
    ))


def peel(cells: Column, level: int = 0) -> Column:
    """``(ok, left, right)``: whether the sketch was emptied, and the digests recovered of either side.

    A cell with one digest of one side gives it away; it leaves its other
    cells, which lays open more of them.
    """
    def step(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (_check(c["d"]) == c["h"]))
        entries = F.array_distinct(F.transform(pure, lambda c: _entry(c["d"], c["n"], level)))
        found = lambda sign, es: F.transform(F.filter(es, lambda e: e["s"] == sign), lambda e: e["d"])
        less = lambda e: F.struct((-e["s"]).alias("s"), e["d"].alias("d"), e["h"].alias("h"))
        return _let(entries, lambda es: F.when(F.size(es) == 0, state).otherwise(F.struct(
            F.transform(state["cells"], lambda c: F.aggregate(F.filter(es, lambda e: _in_cell(e, c["i"])), c, lambda x, e: _add(x, less(e)))).alias("cells"),
            F.concat(state["left"], found(1, es)).alias("left"), F.concat(state["right"], found(-1, es)).alias("right"),
        )))

    none = F.array().cast("array<bigint>")
    start = F.struct(cells.alias("cells"), none.alias("left"), none.alias("right"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(PEEL_STEPS)), start, step)
    return _let(done, lambda s: F.struct(
        F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["d"] == 0) & (c["h"] == 0)).alias("ok"),
        s["left"].alias("left"), s["right"].alias("right"),
    ))


def text_of(cells: Column) -> Column:
    """A sketch as text: count, digests and check values of every cell."""
    number = lambda x, n: F.right(F.lpad(F.hex(x), n, "0"), F.lit(n))
    return F.base64(F.unhex(F.array_join(F.transform(cells, lambda c: F.concat(number(c["n"], 4), number(c["d"], 16), number(c["h"], 8))), "")))


def differing(pairs: DataFrame) -> DataFrame:
    """``(rid, kind, left, right)``: how many digests only one side of ``pairs (rid, kind, a, b)`` holds.

    For pairs whose first sketch could not be emptied: both sides are dealt
    into parts by a hash, with a sketch each. Parts that fail are dealt again with other
    hashes until none is left; a part stays small, so work follows the size of the text.
    """
    results, rest, level = None, pairs, 0
    while level == 0 or not rest.isEmpty():
        level += 1
        if level > 40:
            raise RuntimeError("sketches do not come apart")
        size = F.size("a") + F.size("b")
        parts = F.least(F.lit(MAX_SPLIT), F.greatest(F.lit(2), F.ceil(size / SPLIT))).cast("int")
        mine = lambda side, g: F.filter(side, lambda d: F.pmod(F.xxhash64(d, F.lit(1000 + level)), F.col("parts")) == g)  # noqa: E731,B023
        dealt = rest.withColumn("parts", parts).select("rid", "kind", F.inline(F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1), lambda g: F.struct(mine(F.col("a"), g).alias("a"), mine(F.col("b"), g).alias("b"))
        )))
        peeled = staged(
            dealt.filter((F.size("a") > 0) | (F.size("b") > 0))
            .withColumn("p", peel(subtract(sketch(F.col("a"), level), sketch(F.col("b"), level)), level))
            .select(
                "rid", "kind", F.col("p.ok").alias("ok"), F.size("p.left").alias("left"), F.size("p.right").alias("right"),
                F.when(~F.col("p.ok"), F.col("a")).alias("a"), F.when(~F.col("p.ok"), F.col("b")).alias("b"),
            ),
            "sketch-parts",
        )
        good = peeled.filter("ok").groupBy("rid", "kind").agg(F.sum("left").alias("left"), F.sum("right").alias("right"))
        results = good if results is None else results.union(good)
        rest = peeled.filter("not ok").select("rid", "kind", "a", "b")
    return results.groupBy("rid", "kind").agg(F.sum("left").alias("left"), F.sum("right").alias("right"))


def _place(edges: Column, id_: Column, part: Column) -> tuple[Column, Column]:
    """Number of the range between ``edges`` that holds a row, and where in that range its ``part`` (0 to 1) lies.

    An id that is an edge several times holds as many ranges, which its rows share out by ``part``.
    """
    below = F.size(F.filter(edges, lambda e: e < id_))
    share = part * F.greatest(F.size(F.filter(edges, lambda e: e == id_)), F.lit(1))
    return (below + F.floor(share)).cast("long"), share - F.floor(share)


def _edges(id_: str, parts: int, accuracy: int) -> Column:
    points = [k / parts for k in range(1, parts)]
    return F.percentile_approx(id_, points, accuracy) if points else F.array_compact(F.array(F.max(F.lit(None).cast("long"))))


def with_ranges(docs: DataFrame) -> DataFrame:
    """``docs`` and ``bucket``: ranges of about ``BUCKET_DOCS`` rows in the order of ids, hashes of texts within an id.

    Edges are quantiles of the ids, then quantiles within every range so found,
    ``EDGES`` at most of either, so outlying and clustered ids change nothing. Rows of a frequent id,
    and those without one, are dealt by the hash of their text. Only equal rows cannot be dealt.
    """
    n = docs.agg(F.count("doc_id").alias("ids"), F.count_if(F.col("doc_id").isNull()).alias("none")).first()
    parts = min(EDGES, math.ceil(math.sqrt(n["ids"] / BUCKET_DOCS))) or 1
    without = min(EDGES * EDGES, math.ceil(n["none"] / BUCKET_DOCS))
    first = docs.agg(_edges("doc_id", parts, ACCURACY)).first()[0] or []
    first = F.array(*[F.lit(e).cast("long") for e in first]).cast("array<bigint>")
    part = F.least(F.xxhash64("text").cast("double") / 2.0**64 + 0.5, F.lit(1 - 2.0**-50))
    low, rest = _place(first, F.col("doc_id"), part)
    placed = docs.withColumn("low", low).withColumn("rest", rest)
    second = placed.filter("doc_id is not null").groupBy("low").agg(_edges("doc_id", parts, 4 * EDGES).alias("edges"))
    fine, _ = _place(F.coalesce("edges", F.array().cast("array<bigint>")), F.col("doc_id"), F.col("rest"))
    bucket = F.when(F.col("doc_id").isNull(), F.floor(part * without) - without).otherwise(F.col("low") * EDGES + fine)
    joined = placed.join(F.broadcast(second), "low", "left")  # at most EDGES rows of as many numbers
    return joined.select(*docs.columns, bucket.cast("long").alias("bucket"))


def _following(buckets: DataFrame) -> DataFrame:
    """``(target, source)``: for every bucket the next smaller one, the largest after the smallest.

    Buckets are ordered in groups of neighbouring numbers; only one row per group is ordered as a whole.
    """
    groups = buckets.withColumn("g", F.expr(f"bucket div {EDGES}"))
    down = Window.partitionBy("g").orderBy(F.col("bucket").desc())
    inner = groups.select("g", F.col("bucket").alias("target"), F.lead("bucket").over(down).alias("source"))
    tops = groups.groupBy("g").agg(F.max("bucket").alias("top"))
    ring = Window.orderBy(F.col("g").desc())
    after = tops.select("g", F.coalesce(F.lead("top").over(ring), F.first("top").over(ring)).alias("top"))
    return inner.join(after, "g").select("target", F.coalesce("source", "top").alias("source"))


def with_next(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text, u)`` with ``next_text`` and ``next_u`` of the next smaller id; the first one after the last.

    Rows are dealt by ranges of equal size, and every range also gets the head of the next one.
    """
    dealt = with_ranges(docs)
    order = F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"), F.xxhash64("text"))
    heads = dealt.groupBy("bucket").agg(F.max_by(F.struct("doc_id", "text", "u"), order).alias("head"))
    heads = staged(heads, "range-heads")
    guests = heads.join(_following(heads.select("bucket")), F.col("bucket") == F.col("source")).select(
        F.col("target").alias("bucket"), "head.*", F.lit(True).alias("guest")
    )
    all_rows = dealt.withColumn("guest", F.lit(False)).unionByName(guests)
    down = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc())
    return (
        all_rows.withColumn("next_text", F.lead("text").over(down)).withColumn("next_u", F.lead("u").over(down))
        .filter("not guest").drop("guest", "bucket")
    )


def likeness(left: Column, right: Column, n_left: Column) -> Column:
    """Shared digests among all of both sides; two empty texts are alike."""
    shared = n_left - left
    everything = n_left + right
    return F.when(everything == 0, F.lit(1.0)).otherwise(shared / everything)


def compare_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited version, and how alike they and the next document are.

    The edited text ends with the beginning of the next document (descending
    ids, the first after the last) instead of its last third. Differences come
    from subtracted sketches that are peeled, larger ones where that fails.
    Null texts are empty. Rows without an id come last, repeated ids in the
    order of a hash of their texts; all rows are kept. A single document is its own next one. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("u", paragraphs(F.col("text")))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    own = (
        with_next(rows)
        .select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "u", "next_u")
        .select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "u", paragraphs(F.col("edited")).alias("e"), F.col("next_u").alias("x"))
        .withColumn("su", sketch(F.col("u"))).withColumn("se", sketch(F.col("e"))).withColumn("sx", sketch(F.col("x")))
    )
    found = staged(
        own.withColumn("pe", peel(subtract(F.col("su"), F.col("se")))).withColumn("px", peel(subtract(F.col("su"), F.col("sx"))))
        .select(
            F.monotonically_increasing_id().alias("rid"), "doc_id", "n_chars", "edited_sha256",
            text_of(F.col("su")).alias("fingerprint"), text_of(F.col("se")).alias("edited_fingerprint"), "u",
            *[F.struct(
                F.col(f"p{k}.ok").alias("ok"), F.size(f"p{k}.left").alias("left"), F.size(f"p{k}.right").alias("right"),
                F.when(~F.col(f"p{k}.ok"), F.col(k)).alias("digests"),
            ).alias(k) for k in ("e", "x")],
        ),
        "fingerprints",
    )
    failed = found.select("rid", "u", F.inline(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(f"{k}.ok").alias("ok"), F.col(f"{k}.digests").alias("b")) for k in ("e", "x")
    ]))).filter("not ok").select("rid", "kind", F.col("u").alias("a"), "b")
    larger = differing(failed).groupBy("rid").agg(*[
        F.max(F.when(F.col("kind") == k, F.struct("left", "right"))).alias(f"l{k}") for k in ("e", "x")
    ])
    side = lambda k, s: F.coalesce(F.col(f"l{k}")[s], F.col(f"{k}.{s}"))
    near = {k: likeness(side(k, "left"), side(k, "right"), F.size("u")) for k in ("e", "x")}
    return found.join(larger, "rid", "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        near["e"].alias("near_edited"), near["x"].alias("near_next"),
    )
