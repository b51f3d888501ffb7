"""Personal data: patterns of known kinds, and bootstrapped contextual extraction. Built-in functions only.

Every text is cut once into identifier-like strings and the words around them.
Strings of a known kind are the seeds. They induce lexical patterns, the words
on either side; patterns and strings form a graph. In each round a pattern is
scored by the share of its strings that are known, and a string by the
patterns it stands in; strings with enough evidence become known in the next.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.plans.joins import checked_join
from lettermill.plans.parallelism import with_columns_once
from lettermill.session import staged

ROUNDS = 5
MIN_SUPPORT = 3  # different known strings that a pattern needs
CONFIDENCE = (4, 5)  # known strings of a pattern, of all its strings and one more
EVIDENCE = 0.9  # probability from which a string is known
CONTEXT = 80  # characters on either side that are looked at
SCALE = 1_000_000  # evidence is summed in whole numbers, so that no order of rows matters

# Possessive groups and starts that cannot lie inside a run already tried keep all patterns linear; the matches are
# those of the plain forms [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+),
# [0-9]([\x20-]?[0-9])+ and \+[0-9][\x20().0-9-]+[0-9].
_LOCAL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
KINDS = {
    "email": _LOCAL + r"(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Anything that may be an identifier: looser than the kinds, and not only theirs.
CANDIDATE = "|".join([
    _LOCAL + r"(?:\.[A-Za-z0-9-]++)*+", r"(?<![0-9.])[0-9]++(?:\.[0-9]++){3,}+", KINDS["phone"],
    r"(?<![A-Za-z0-9])[0-9](?:[\x20-]?[0-9]){5,}+",
    r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])(?=[0-9]*+[A-Za-z])[A-Za-z0-9]{8,}+",
])
SPACE = r"[\x20\x09-\x0D]+"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def valid(kind: str, m: Column) -> Column:
    """Whether a match of the kind's pattern counts."""
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return F.regexp_like(m, F.lit(rf"^{part}(?:\.{part}){{3}}$"))
    if kind == "card":
        n = F.length(_digits(m))
        return F.when((n >= 13) & (n <= 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, numbered: matches of each kind and the lengths of the gaps around them; candidates and their gaps.

    All texts are read once here. Written, so that the row numbers stay.
    """
    none = F.array().cast("array<string>")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    has = lambda mark: F.contains(F.col("t"), F.lit(mark))
    digit = F.col("_digit")  # most texts lack what a match needs; one look tells
    marked = {"email": has("@"), "ip": digit & has("."), "card": digit, "phone": digit & has("+"), "any": digit | has("@")}
    rows = with_columns_once(rows, {"_digit": F.regexp_like("t", F.lit("[0-9]"))})
    found = {k: F.regexp_extract_all("t", F.lit(p), F.lit(0)) for k, p in {**KINDS, "any": CANDIDATE}.items()}
    rows = with_columns_once(rows, {f"{k}_found": F.when(marked[k], m).otherwise(none) for k, m in found.items()}).drop("_digit")
    gaps = {
        f"{k}_gaps": F.when(F.size(f"{k}_found") > 0, F.transform(F.split("t", p, -1), lambda g: F.length(g))) for k, p in KINDS.items()
    }
    around = lambda g: F.struct(
        F.length(g).alias("n"), F.right(g, F.lit(CONTEXT)).alias("tail"), F.left(g, F.lit(CONTEXT)).alias("head")
    )
    gaps["any_gaps"] = F.when(F.size("any_found") > 0, F.transform(F.split("t", CANDIDATE, -1), around))
    rows = with_columns_once(rows, gaps).drop("t")
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "identifier-cuts")


def _placed(cuts: DataFrame, pairs: Column, length: Column) -> DataFrame:
    """Matches with ``start`` and ``end``: the running sum of the gaps and matches of the row; ``x`` holds value and gap."""
    upto = F.sum(length + F.length("x.value")).over(Window.partitionBy("row").orderBy("j").rowsBetween(Window.unboundedPreceding, 0))
    rows = cuts.select("row", F.posexplode(pairs).alias("j", "x"))
    return rows.withColumn("end", upto).withColumn("start", F.col("end") - F.length("x.value"))


def base_spans(cuts: DataFrame) -> DataFrame:
    """``(row, kind, start, end)`` of the valid matches of every kind, by its number; places count code points."""

    def of(number: int, kind: str) -> DataFrame:
        pairs = F.expr(f"transform({kind}_found, (v, i) -> struct(v as value, {kind}_gaps[i] as gap))")
        placed = _placed(cuts.filter(F.size(f"{kind}_found") > 0), pairs, F.col("x.gap"))
        return placed.filter(valid(kind, F.col("x.value"))).select("row", F.lit(number).alias("kind"), "start", "end")

    return staged(reduce(DataFrame.unionByName, (of(i, k) for i, k in enumerate(KINDS))), "base-spans")


def candidates(cuts: DataFrame) -> DataFrame:
    """``(row, value, start, end, kind, patterns)`` of every candidate; ``kind`` is null unless it is of a known kind.

    Patterns are the two words before, one word on either side, and the two
    words behind. Another candidate or an end of the text stands for a word.
    """
    pairs = F.expr(
        "transform(any_found, (v, i) -> struct(v as value, any_gaps[i] as gap, any_gaps[i + 1].head as head, i = size(any_found) - 1 as last))"
    )
    placed = _placed(cuts.filter(F.size("any_found") > 0), pairs, F.col("x.gap.n"))
    words = lambda c: F.filter(F.split(F.lower(c), SPACE), lambda w: w != "")
    placed = with_columns_once(placed, {"_l": words(F.col("x.gap.tail")), "_r": words(F.col("x.head"))})
    before, behind = (F.when(c, F.lit("<end>")).otherwise(F.lit("<id>")) for c in (F.col("j") == 0, F.col("x.last")))
    left = [F.coalesce(F.try_element_at("_l", F.lit(-k)), before) for k in (1, 2)]
    right = [F.coalesce(F.try_element_at("_r", F.lit(k)), behind) for k in (1, 2)]
    slot = F.lit("_")
    patterns = F.array(
        F.concat_ws(" ", left[1], left[0], slot), F.concat_ws(" ", left[0], slot, right[0]), F.concat_ws(" ", slot, right[0], right[1])
    )
    value = F.col("x.value")
    kind = F.coalesce(*[
        F.when(F.regexp_like(value, F.lit(f"^(?:{p})$")) & valid(k, value), F.lit(i)) for i, (k, p) in enumerate(KINDS.items())
    ])
    return staged(placed.select("row", value.alias("value"), "start", "end", kind.alias("kind"), patterns.alias("patterns")), "candidates")


def score_patterns(edges: DataFrame, known: DataFrame) -> DataFrame:
    """``(pattern, kind, evidence)`` of the patterns whose strings are mostly known, and of one kind."""
    by_kind = [F.count_if(F.col("kind") == i).alias(f"n{i}") for i in range(len(KINDS))]
    counts = checked_join(edges, known, "value").groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *by_kind)
    best = F.greatest(*[F.struct(F.col(f"n{i}").alias("n"), F.lit(-i).alias("kind")) for i in range(len(KINDS))])
    share = F.col("best.n") / (F.col("n") + 1)
    return (
        counts.withColumn("best", best)
        .filter((F.col("best.n") >= MIN_SUPPORT) & (F.col("best.n") * CONFIDENCE[1] >= (F.col("n") + 1) * CONFIDENCE[0]))
        .select("pattern", (-F.col("best.kind")).alias("kind"), F.round(-SCALE * F.log(1 - share)).cast("long").alias("evidence"))
    )


def discover(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(value, kind)`` of the strings that become known; seeds are not among them.

    A string's evidence for a kind is that of all its patterns together, each
    an independent witness; the kind with most of it, then the first, wins. Ends
    when a round finds nothing, or after ``rounds``.
    """
    edges = staged(
        found.select("value", F.explode("patterns").alias("pattern")).distinct(), "pattern-edges"
    )
    seeds = staged(found.filter("kind is not null").select("value", "kind").distinct(), "seeds")
    known, new = seeds, []
    needed = round(-SCALE * log(1 - EVIDENCE))
    for _ in range(rounds):
        patterns = staged(score_patterns(edges, known), "patterns")
        held = checked_join(edges, patterns, "pattern", "inner")
        scored = held.groupBy("value", "kind").agg(F.sum("evidence").alias("evidence")).filter(F.col("evidence") >= needed)
        best = F.max(F.struct("evidence", (-F.col("kind")).alias("kind"))).alias("best")
        strong = scored.groupBy("value").agg(best).select("value", (-F.col("best.kind")).alias("kind"))
        fresh = staged(strong.join(known.select("value"), "value", "left_anti"), "discovered")
        if fresh.isEmpty():
            break
        new.append(fresh)
        known = staged(known.unionByName(fresh), "known")
    return reduce(DataFrame.unionByName, new) if new else seeds.limit(0)


def extra_spans(found: DataFrame, discovered: DataFrame, base: DataFrame) -> DataFrame:
    """Spans of discovered strings that do not touch a base span of their document."""
    spans = checked_join(found.filter("kind is null").drop("kind"), discovered, "value", "inner")
    spans = spans.select("row", "kind", "start", "end", F.lit(True).alias("extra"))
    held = base.join(spans.select("row").distinct(), "row", "left_semi").withColumn("extra", F.lit(False))
    order = Window.partitionBy("row").orderBy("start", "end", "extra", "kind")
    edge = lambda c, f: f(F.when(~F.col("extra"), F.col(c)))
    before = edge("end", F.max).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = edge("start", F.min).over(order.rowsBetween(1, Window.unboundedFollowing))
    clear = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("after", F.col("end")) >= F.col("end"))
    return spans.unionByName(held).withColumns({"before": before, "after": after}).filter(F.col("extra") & clear).select("row", "kind", "start", "end")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of every row.

    Counts and ``base_sha256`` are of the matches of ``KINDS``; ``spans`` adds
    the discovered strings, under the kind their contexts are of. Places are
    code points from 0, the end is exclusive. Null and empty texts have none.
    Repeated rows, and rows of one id or none, are each scanned by themselves.
    Other columns are not read; an empty table gives no rows.
    """
    cuts = cut_texts(docs, id_col, text_col)
    base = base_spans(cuts)
    found = candidates(cuts)
    extra = extra_spans(found, discover(found, rounds), base)
    every = base.withColumn("extra", F.lit(False)).unionByName(extra.withColumn("extra", F.lit(True)))
    names = F.array(*map(F.lit, KINDS))
    label = F.concat_ws(":", F.get(names, F.col("kind")), F.col("start").cast("string"), F.col("end").cast("string"))
    entry = F.struct("kind", "start", "end", label.alias("label"))
    listed = lambda entries: F.array_join(F.transform(F.sort_array(entries), lambda e: e["label"]), ",")
    spans = every.groupBy("row").agg(  # the spans of one text
        *[F.count_if((F.col("kind") == i) & ~F.col("extra")).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        listed(F.collect_list(F.when(~F.col("extra"), entry))).alias("base"), listed(F.collect_list(entry)).alias("spans"),
    )
    held = cuts.filter(reduce(Column.__or__, (F.size(f"{k}_found") > 0 for k in [*KINDS, "any"])))
    bare = cuts.filter(~reduce(Column.__or__, (F.size(f"{k}_found") > 0 for k in [*KINDS, "any"])))
    some = held.select("row", "doc_id").join(spans, "row", "left")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    counts = [f"n_{k}" for k in KINDS]
    some = some.select(
        "doc_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.sha2(text("base").cast("binary"), 256).alias("base_sha256"), text("spans").alias("spans"),
    )
    zero = [F.lit(0).cast("long").alias(c) for c in counts]
    return some.unionByName(bare.select("doc_id", *zero, F.sha2(F.lit("").cast("binary"), 256).alias("base_sha256"), F.lit("").alias("spans")))
