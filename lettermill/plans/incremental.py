"""Repeatable corpus build: only mailboxes that changed since the last run are read, and only their folders replaced.

``output/_manifest/run=N`` lists every mailbox with a digest of its files and
its counters. A run compares the digests with the newest complete list, builds
what differs, replaces those folders, and writes the next list last. A run that
stops half-way leaves the old list; the next one builds the same mailboxes again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.operators.examples import build_examples
from lettermill.operators.language import LanguageModel
from lettermill.operators.reports import COUNTERS, counters, stats_of_counters
from lettermill.plans.corpus import JUDGED_COLUMNS, judge_messages, mailbox_key
from lettermill.session import staged
from lettermill.sources.jsonl import write_examples
from lettermill.sources.mailbox import check_mailboxes, mailbox_files, read_messages, small_batches

_MANIFEST = "source string, mailbox string, digest string, " + ", ".join(f"{c} long" for c in COUNTERS)


def mailbox_digests(spark: SparkSession, path: str, version: str = "") -> DataFrame:
    """``(source, mailbox, digest, files)`` of every mailbox; contents are not read.

    The digest is of the names, lengths and times of change of a mailbox's files,
    and of ``version``, which stands for the rules and the model of the build.
    """
    names = F.struct("file", "length", F.unix_micros("modified").alias("modified"))
    found = mailbox_files(spark, path).groupBy("source").agg(F.sort_array(F.collect_list(names)).alias("files"))
    text = F.concat(F.lit(f"{version}\n"), F.to_json("files"))
    return found.select("source", mailbox_key(F.col("source")).alias("mailbox"), F.sha2(text.cast("binary"), 256).alias("digest"), F.col("files.file").alias("files"))


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _runs(spark: SparkSession, output: str) -> list[int]:
    """Numbers of the complete lists."""
    files, folder = _folder(spark, f"{output}/_manifest")
    if not files.exists(folder):
        return []
    paths = [status.getPath() for status in files.listStatus(folder)]
    complete = [p for p in paths if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(m[1]) for p in complete if (m := re.fullmatch(r"run=(\d+)", p.getName())))


def manifest(spark: SparkSession, output: str) -> DataFrame:
    """The newest complete list of mailboxes; no rows before the first run."""
    output = output.rstrip("/")
    runs = _runs(spark, output)
    if not runs:
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(f"{output}/_manifest/run={runs[-1]}")


def update_corpus(spark: SparkSession, mailboxes: str, output: str, model: LanguageModel, version: str = "") -> DataFrame:
    """Bring ``output/mailbox=.../*.json`` up to date with ``mailboxes``; returns the counters of the whole corpus.

    The same as a whole build, with two more columns: ``rebuilt`` and ``removed``
    count the mailboxes of this run. A run that finds nothing changed writes
    nothing. A mailbox that is gone, or has no accepted message any more, loses
    its folder. Only names and counters of mailboxes come to the driver.
    """
    check_mailboxes(spark, mailboxes)
    output = output.rstrip("/")
    old = manifest(spark, output)
    current = staged(mailbox_digests(spark, mailboxes, version), "mailboxes")
    before = old.select("source", F.col("digest").alias("old_digest"))
    changed = staged(current.join(before, "source", "left").filter("not digest <=> old_digest").drop("old_digest"), "changed")
    gone = [r["mailbox"] for r in old.join(current, "source", "left_anti").select("mailbox").collect()]
    files = [f for r in changed.select("files").collect() for f in r["files"]]
    if not files and not gone:
        return _report(old, 0, 0)
    names = staged(_rebuilt(spark, changed, files, output, model), "rebuilt") if files else spark.createDataFrame([], _MANIFEST)
    empty = [r["mailbox"] for r in names.filter("processed = 0").select("mailbox").collect()]
    for mailbox in [*gone, *empty]:
        fs, folder = _folder(spark, f"{output}/mailbox={mailbox}")
        fs.delete(folder, True)
    kept = old.join(current, "source", "left_semi").join(changed, "source", "left_anti")
    listed = kept.unionByName(names)
    number = max(_runs(spark, output), default=0) + 1
    listed.write.mode("overwrite").parquet(f"{output}/_manifest/run={number}")
    return _report(manifest(spark, output), names.count(), len(gone))


def _rebuilt(spark: SparkSession, changed: DataFrame, files: list[str], output: str, model: LanguageModel) -> DataFrame:
    """Replace the folders of the changed mailboxes; returns their rows of the list."""
    escaped = [re.sub(r"([\\*?\[\]{},])", r"\\\1", f) for f in files]
    with small_batches(spark):
        judged = staged(judge_messages(read_messages(spark, escaped), model).select(*JUDGED_COLUMNS), "judged")
    named = judged.filter(F.col("status") == "ok").withColumn("mailbox", mailbox_key(F.col("source")))
    write_examples(build_examples(named, keep=("mailbox",)), output, by="mailbox", mode="dynamic")
    counted = judged.groupBy("source").agg(*counters())
    zero: list[Column] = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTERS]
    return changed.join(counted, "source", "left").select("source", "mailbox", "digest", *zero)


def _report(listed: DataFrame, rebuilt: int, removed: int) -> DataFrame:
    stats = stats_of_counters(listed)
    return stats.withColumns({"rebuilt": F.lit(rebuilt).cast("long"), "removed": F.lit(removed).cast("long")})
