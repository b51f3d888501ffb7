"""Counters and a limit per mailbox on a stream, in keyed state that survives a restart.

The state of a mailbox is one row of numbers. Rows of a mailbox are thinned where they
are read, to partial counters or, under a limit, to the first messages of each
Arrow batch, so that a mailbox with most of the messages sends little to its state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lettermill.operators.reports import COUNTERS

_STATE = (*COUNTERS, "late", "upto", "updates")
_SENT = ("place", "of", *COUNTERS)  # one message, or the sums of some: first and last place
UNSEEN = -(2**63)


def _sums(rows: DataFrame) -> DataFrame:
    """One row of numbers per message."""
    ok = F.col("status") == "ok"
    values = {
        "total": F.lit(1), "processed": ok.cast("int"), "skipped_empty": (F.col("status") == "empty").cast("int"),
        "skipped_short": (F.col("status") == "short").cast("int"), "failed": (F.col("status") == "error").cast("int"),
        "total_words": F.when(ok, F.col("n_words")).otherwise(F.lit(0)),
    }
    numbers = [F.coalesce(values[c], F.lit(0)).cast("long").alias(c) for c in COUNTERS]
    place = F.col("place").cast("long")
    return rows.filter(F.col("place").isNotNull()).select("source", place.alias("place"), place.alias("of"), *numbers)


def _thinned(n: int | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if n:
                rank = rows.groupby("source", dropna=False)["place"].rank(method="first")
                yield rows[rank <= n]
            else:
                how = {"place": "min", "of": "max", **{c: "sum" for c in COUNTERS}}
                yield rows.groupby("source", dropna=False, as_index=False).agg(how)[["source", *_SENT]]

    return thin


def _taken(n: int | None) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    def take(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = dict(zip(_STATE, state.get)) if state.exists else {**dict.fromkeys(_STATE, 0), "upto": UNSEEN}
        before, need = old["upto"], n - old["total"] if n else None
        sums, late, upto = np.zeros(len(COUNTERS), np.int64), 0, before
        held = np.zeros((0, len(_SENT)), np.int64)  # under a limit the first messages seen so far, ``need`` at most
        for rows in batches:
            values = rows[list(_SENT)].to_numpy(np.int64)
            is_late = values[:, 0] <= before
            late += int(values[is_late, 2].sum())
            if need is None:
                sums += values[:, 2:].sum(axis=0)
                upto = max(upto, int(values[:, 1].max(initial=UNSEEN)))
            elif need > 0:
                held = np.concatenate((held, values[~is_late]))
                held = held[np.argsort(held[:, 0], kind="stable")[:need]]
        if need is not None and len(held):
            sums, upto = held[:, 2:].sum(axis=0), int(held[-1, 0])
        new = {c: old[c] + int(s) for c, s in zip(COUNTERS, sums)}
        new |= {"late": old["late"] + late, "upto": upto, "updates": old["updates"] + 1}
        state.update(tuple(new[c] for c in _STATE))
        yield pd.DataFrame({"source": [key[0]], **{c: [new[c]] for c in _STATE}})

    return take


def mailbox_counters(judged: DataFrame, n: int | None = None) -> DataFrame:
    """Counters of every mailbox after each micro-batch that holds messages of it, over its first ``n`` messages.

    ``judged`` is a stream with ``source``, ``place`` (a whole number that orders the messages of a mailbox),
    ``status`` and ``n_words``. 0 or None counts all. ``upto`` is the last place taken,
    ``updates`` numbers the rows of a mailbox, null is a mailbox, and rows without a place do not count.
    Mailboxes grow at the end, so places rise from one micro-batch to the next; within one they may come
    in any order. ``late`` counts messages that came behind a later one. Under a limit they are not taken; without
    one they count like all, and ``late`` holds all messages of an Arrow batch with such a one. While it is 0 the last
    row equals the batch result.
    """
    sent = "source string, " + ", ".join(f"{c} long" for c in _SENT)
    numbers = ", ".join(f"{c} long" for c in _STATE)
    thin = _sums(judged).mapInPandas(_thinned(n), sent)
    return thin.groupBy("source").applyInPandasWithState(
        _taken(n), f"source string, {numbers}", numbers, "append", GroupStateTimeout.NoTimeout
    )


def write_counters(counted: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table; processes what is there and stops. A later call goes on from the checkpoint."""
    return (
        counted.writeStream.format("parquet").outputMode("append")
        .option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_counters(spark: SparkSession, output: str) -> DataFrame:
    """``(source, COUNTERS, late, upto)`` of every mailbox, as of the last micro-batch that was written whole."""
    newest = F.max_by(F.struct(*[c for c in _STATE if c != "updates"]), "updates")
    return spark.read.parquet(output).groupBy("source").agg(newest.alias("newest")).select("source", "newest.*")


def admitted(messages: DataFrame, counters: DataFrame) -> DataFrame:
    """The ``messages (source, place, ...)`` that the limit let through: up to the last place taken of their mailbox."""
    last = counters.select(F.col("source").alias("_source"), F.col("upto").alias("_upto"))
    return messages.join(last, F.col("source").eqNullSafe(F.col("_source")) & (F.col("place") <= F.col("_upto")), "left_semi")
