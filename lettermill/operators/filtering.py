"""Accept or reject messages, with the reason kept as a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.functions.cleaning import clean_text
from lettermill.functions.fixed_values import MIN_WORDS
from lettermill.functions.text import word_count
from lettermill.plans.parallelism import with_columns_once
from lettermill.session import staged

RANGES = 1024  # parts of a range of numbers, per step
BOUNDARY_ROWS = 1_000_000  # rows of a group that are ranked together, at most


def with_clean_text(emails: DataFrame, body: str = "body") -> DataFrame:
    """Adds ``clean`` and ``n_words``; both are computed once, whatever filters follow."""
    cleaned = with_columns_once(emails, {"clean": clean_text(F.col(body))})
    return with_columns_once(cleaned, {"n_words": word_count(F.col("clean"))})


def status(body: Column, n_words: Column, error: Column | None = None) -> Column:
    """``error``, ``empty`` (judged before cleaning), ``short`` (after it) or ``ok``."""
    reason = F.when(body.isNull() | (body == ""), "empty").when(n_words < MIN_WORDS, "short").otherwise("ok")
    return reason if error is None else F.when(error.isNotNull(), "error").otherwise(reason)


def with_status(emails: DataFrame, body: str = "body") -> DataFrame:
    """Adds ``clean``, ``n_words`` and ``status``; no row is lost."""
    error = F.col("error") if "error" in emails.columns else None
    return with_clean_text(emails, body).withColumn("status", status(F.col(body), F.col("n_words"), error))


def accepted(emails: DataFrame, body: str = "body") -> DataFrame:
    return with_status(emails, body).filter(F.col("status") == "ok").drop("status")


def first_n_per_group(df: DataFrame, group: str, order: str, n: int | None) -> DataFrame:
    """First ``n`` rows of every group by a unique integer ``order``; 0 or None keeps all.

    NULL is a group like any other; rows with a NULL ``order`` come after all
    numbers and are not kept. Rows are counted per (group, range of numbers): whole ranges before
    the cut are kept, the range that holds it is divided until it has at most
    ``BOUNDARY_ROWS`` rows, and only these are ranked. So no step ranks a whole
    group, whatever ``n`` and however many rows the group holds.
    """
    if not n:
        return df
    wide = F.col(order).cast("decimal(20,0)")
    same = lambda left, right: left[group].eqNullSafe(right["_group"])
    cuts = df.filter(F.col(order).isNotNull()).groupBy(F.col(group).alias("_group")).agg(
        F.min(wide).alias("_lo"), F.max(wide).alias("_hi"), F.lit(n).cast("long").alias("_need")
    )
    hottest = None
    while hottest is None or hottest > BOUNDARY_ROWS:
        cuts = cuts.withColumn("_width", F.expr(f"((_hi - _lo) div {RANGES}) + 1"))
        rows = df.select(group, wide.alias("_order"))
        counts = (
            rows.join(cuts, same(rows, cuts))
            .filter(F.col("_order").between(F.col("_lo"), F.col("_hi")))
            .groupBy("_group", "_lo", "_hi", "_need", "_width", F.expr("(_order - _lo) div _width").alias("_slot"))
            .agg(F.count(F.lit(1)).alias("_rows"))
        )
        running = F.sum("_rows").over(Window.partitionBy("_group").orderBy("_slot"))
        last = F.max("_upto").over(Window.partitionBy("_group"))
        first = F.expr("cast(_lo + cast(_slot as decimal(20,0)) * cast(_width as decimal(20,0)) as decimal(20,0))")
        counts = counts.withColumn("_upto", running).withColumn("_need", F.least("_need", last))
        found = counts.filter((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_rows") < F.col("_need"))).select(
            "_group",
            first.alias("_lo"),
            F.least("_hi", first + F.col("_width") - 1).cast("decimal(20,0)").alias("_hi"),
            (F.col("_need") - F.col("_upto") + F.col("_rows")).alias("_need"),
            "_rows",
        )
        cuts = staged(found, "cuts")
        hottest = cuts.agg(F.max("_rows")).first()[0] or 0
        if cuts.filter((F.col("_rows") > BOUNDARY_ROWS) & (F.col("_lo") == F.col("_hi"))).limit(1).count():
            raise ValueError(f"{order} is not unique: more than {BOUNDARY_ROWS} rows of a group share one value")
        cuts = cuts.drop("_rows")
    marked = df.join(cuts, same(df, cuts))
    rank = F.row_number().over(Window.partitionBy("_group").orderBy(order))
    at_cut = marked.filter(wide.between(F.col("_lo"), F.col("_hi"))).withColumn("_rank", rank)
    kept = [F.col(c) for c in df.columns]
    return marked.filter(wide < F.col("_lo")).select(*kept).unionByName(
        at_cut.filter(F.col("_rank") <= F.col("_need")).select(*kept)
    )
