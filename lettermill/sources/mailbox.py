"""Mailbox files as a splittable source.

A mailbox is text whose messages start at ``From `` lines, so Spark's text
reader with that separator splits files of any size over tasks. Values stay
raw bytes until the message parser, which runs on Arrow batches in the workers.

Message order is ``(file, block_start, pos)``: the split a message was read in,
and its place there. No global sort is needed to keep it.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from email import message_from_bytes
from email.message import Message

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lettermill.functions.mime import HTML, PLAIN
from lettermill.plans.joins import checked_join

SEPARATOR = "\nFrom "
# ``part-*`` are the files of a mailbox folder that Spark has written.
FILE_NAMES = "{mbox,*.mbox,part-*}"
MAILBOX_FILE = r"\.mbox$|\.mbox/mbox$|\.mbox/part-[^/]*$"
FOLDER_MEMBER = r"/(?:mbox|part-[^/]*)$"

RAW_RECORDS = 64  # raw records that Spark hands to the parser at a time, at most
SLICE_RECORDS = 16  # raw records that are Python objects at a time
PARSED_RECORDS = 256  # parsed messages handed on together, at most
PARSED_BYTES = 1 << 20  # raw bytes after which parsed messages are handed on

MESSAGE_SCHEMA = """
    source string, file string, block_start long, pos long,
    headers map<string, string>, multipart boolean,
    parts array<struct<part_no: int, content_type: string, disposition: string, payload: binary>>,
    error string
"""


def _source(file: Column) -> Column:
    """The mailbox a file belongs to: the file itself, or its folder ``X.mbox``. ``file`` is a plain path."""
    return F.regexp_replace(file, FOLDER_MEMBER, "")


def _plain_path(uri: Column) -> Column:
    """Path of a file's address with its characters as they are; ``+`` stands for itself."""
    return F.regexp_replace(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def check_mailboxes(spark: SparkSession, path: str, any_name: bool = False) -> None:
    """Raise where there is nothing to read, or where a mailbox would be passed over.

    Spark's readers skip names that begin with ``_`` or ``.``; losing such a
    mailbox in silence is worse than asking for another name.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    start, found, hidden = root.toUri().getPath().rstrip("/"), 0, []
    while files.hasNext():
        name = files.next().getPath().toUri().getPath()
        inside = name[len(start) :]
        if any_name or re.search(MAILBOX_FILE, name):
            found += 1
            if re.search(r"(^|/)[_.]", inside or name.rsplit("/", 1)[-1]):
                hidden.append(name)
    if hidden:
        raise ValueError(f"{len(hidden)} mailboxes have names that Spark skips; rename: {', '.join(hidden[:5])}")
    if not found:
        raise FileNotFoundError(f"no mailbox below {path}")


def mailbox_files(spark: SparkSession, path: str) -> DataFrame:
    """Mailbox files below ``path``, each once, with size and time of change; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", FILE_NAMES)
        .load(path)
    )
    path_name = F.regexp_replace("path", "^file:/+", "file:/")  # this reader gives it unescaped
    return files.select(
        _source(path_name).alias("source"), path_name.alias("file"), "length", F.col("modificationTime").alias("modified")
    ).filter(F.col("file").rlike(MAILBOX_FILE))


def find_mailboxes(spark: SparkSession, path: str) -> DataFrame:
    """Mailbox files below ``path``, each once, with their size; contents are not read."""
    return mailbox_files(spark, path).drop("modified")


def scan_mailboxes(spark: SparkSession, path: str | list[str], any_name: bool = False) -> DataFrame:
    """Raw records ``(source, file, block_start, last_block, raw)`` in file order inside each block.

    ``any_name`` reads every file below ``path`` as a mailbox, whatever it is called.
    A list holds mailbox files.
    """
    reader = spark.read.option("lineSep", SEPARATOR).option("recursiveFileLookup", "true")
    if not any_name:
        reader = reader.option("pathGlobFilter", FILE_NAMES)
    file, start = _plain_path(F.col("_metadata.file_path")), F.col("_metadata.file_block_start")
    records = reader.text(path).select(
        _source(file).alias("source"),
        file.alias("file"),
        start.alias("block_start"),
        (start + F.col("_metadata.file_block_length") == F.col("_metadata.file_size")).alias("last_block"),
        F.col("value").cast("binary").alias("raw"),
    )
    inside = any_name or (isinstance(path, str) and path.rstrip("/").endswith((".mbox", "/mbox")))
    return records if inside else records.filter(F.col("file").rlike(MAILBOX_FILE))


def _message_bytes(raw: bytes, first_in_file: bool, last_in_file: bool) -> bytes | None:
    """Record to message: no envelope line, no separating blank line; None before the first envelope."""
    if first_in_file and not raw.startswith(b"From "):
        return None
    _, _, message = raw.partition(b"\n")
    if last_in_file:
        return message[:-1] if message.endswith(b"\n\n") else message
    return message if message.endswith(b"\n") else message + b"\n"


def _header_text(value: object) -> str:
    if not isinstance(value, str):
        raise ValueError("header holds bytes that are not ASCII")
    return value


def _parts(message: Message) -> list[dict]:
    """Depth-first parts. Payloads of other types than text are never used and stay out."""
    found = []
    for number, part in enumerate(message.walk()):
        kind = part.get_content_type()
        disposition = part.get("Content-Disposition")
        found.append(
            {
                "part_no": number,
                "content_type": kind,
                "disposition": None if disposition is None else str(disposition),
                "payload": part.get_payload(decode=True) if kind in (PLAIN, HTML) else None,
            }
        )
    return found


def _parse(raw: bytes) -> dict:
    try:
        message = message_from_bytes(raw)
        headers: dict[str, str] = {}
        for name in ("Subject", "From", "To"):
            value = message.get(name)
            if value is not None:
                headers[name] = _header_text(value)
        return {
            "headers": headers,
            "multipart": message.is_multipart(),
            "parts": _parts(message),
            "error": None,
        }
    except Exception as problem:  # a bad message is a row with a reason, not the end of the job
        return {"headers": {}, "multipart": False, "parts": [], "error": f"{type(problem).__name__}: {problem}"}


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(source, file, block_start, pos, last_in_file, raw)``, taken from the batch a few at a time.

    One record is held back, because only its successor tells whether it was the
    last of its block.
    """
    held, pos = None, 0
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_RECORDS):
            for row in zip(*(column.to_pylist() for column in batch.slice(first, SLICE_RECORDS).columns)):
                if held is not None:
                    same = held[1:3] == row[1:3]
                    yield (*held[:3], pos, held[3] and not same, held[4])
                    pos = pos + 1 if same else 0
                held = row
    if held is not None:
        yield (*held[:3], pos, held[3], held[4])


def _parser(schema: pa.Schema, limit: int | None):
    """Parses a batch of any size in small ones: parsed messages take several times the memory of raw ones."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        size = 0
        for source, file, start, pos, last, raw in _records(batches):
            message = _message_bytes(raw, start == 0 and pos == 0, last)
            if message is not None and not (limit and pos > limit):
                rows.append({"source": source, "file": file, "block_start": start, "pos": pos, **_parse(message)})
                size += len(message)
            if size > PARSED_BYTES or len(rows) >= PARSED_RECORDS:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    return parse


_BATCH_LIMIT = "spark.sql.execution.arrow.maxRecordsPerBatch"
_lock = threading.Lock()
_held: dict[SparkSession, list] = {}  # users of ``small_batches`` in each session, and the limit before


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, actions hand ``RAW_RECORDS`` rows at most to a Python worker at a time; a lower limit of the caller holds.

    A batch is whole in the worker, and the one before it still is when it comes:
    with Spark's own limit of 10,000 rows or 64 MB the parser's memory would
    follow the size of the files. Actions take the limit when they start, so
    whoever runs the parser does it in here. The size of batches changes no
    result. The last of several threads puts back what the first has found.
    """
    with _lock:
        held = _held.setdefault(spark, [0, spark.conf.get(_BATCH_LIMIT, None)])
        held[0] += 1
        if not 0 < int(spark.conf.get(_BATCH_LIMIT)) <= RAW_RECORDS:  # zero and less: no limit
            spark.conf.set(_BATCH_LIMIT, str(RAW_RECORDS))
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                del _held[spark]
                if held[1] is None:
                    spark.conf.unset(_BATCH_LIMIT)
                else:
                    spark.conf.set(_BATCH_LIMIT, held[1])


def read_messages(
    spark: SparkSession, path: str | list[str], limit: int | None = None, any_name: bool = False
) -> DataFrame:
    """Parsed messages, one row each. Run it in ``small_batches``.

    ``limit`` only spares the parser what can never be among the first ``limit``
    messages of a mailbox; ``with_message_index`` applies the limit exactly.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(spark.createDataFrame([], MESSAGE_SCHEMA).schema)
    return scan_mailboxes(spark, path, any_name).mapInArrow(_parser(schema, limit), MESSAGE_SCHEMA)


def stage_messages(
    spark: SparkSession, source_path: str, table_path: str, limit: int | None = None, any_name: bool = False
) -> DataFrame:
    """Parse once and keep the text parts as a table, far smaller than mailboxes with attachments.

    Everything after this reads columns of the table instead of parsing again.
    """
    with small_batches(spark):
        read_messages(spark, source_path, limit, any_name).write.parquet(table_path)
    return spark.read.parquet(table_path)


def with_message_index(staged: DataFrame, limit: int | None = None) -> DataFrame:
    """Adds ``msg_idx``, the 0-based place of a message in its mailbox; keeps the first ``limit``.

    Only counts per block are ordered, never messages: a mailbox that holds a
    third of all mail adds one row per 128 MB to that window. The starts are
    broadcast up to a million blocks, about 150 MB for 128 TB of mail.
    """
    before = (
        Window.partitionBy("source")
        .orderBy("file", "block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        staged.groupBy("source", "file", "block_start")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("pos").alias("_first"))
        .select(
            "file",
            "block_start",
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start"),
        )
    )
    indexed = (
        checked_join(staged, starts, ["file", "block_start"], "inner", max_rows=1_000_000)
        .withColumn("msg_idx", F.col("_start") + F.col("pos"))
        .drop("_start")
    )
    return indexed.filter(F.col("msg_idx") < limit) if limit else indexed


def part_rows(messages: DataFrame, *keep: str) -> DataFrame:
    """One row per part in depth-first order."""
    return messages.select(*keep, "multipart", F.inline("parts"))


def mailbox_record(headers: Column, body: Column) -> Column:
    """Text of one mailbox record, with body lines that look like envelopes quoted."""
    quoted = F.regexp_replace(body, "(?m)(?d)^From ", ">From ")
    end = F.when(body == "", "").otherwise("\n")
    return F.concat(F.lit("From MAILER-DAEMON Thu Jan  1 00:00:00 1970\n"), headers, F.lit("\n\n"), quoted, end)


def write_mailboxes(
    records: DataFrame, path: str, source: str, order: str, files: int | None = None, mode: str = "errorifexists"
) -> None:
    """Write ``record`` texts as mailbox folders ``source=X.mbox`` in the given order.

    Ranges of ``order`` become files in name order, so reading gives it back.
    The mode ``append`` adds files to the mailboxes that are there.
    """
    ranged = records.repartitionByRange(*([files] if files else []), order).sortWithinPartitions(source, order)
    ranged.select(source, "record").write.mode(mode).partitionBy(source).text(path)
