"""Columns over message headers and parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lettermill.functions.html import html_to_text, wrap_lines
from lettermill.functions.text import strip

PLAIN = "text/plain"
HTML = "text/html"
REPLACEMENT = "�"


def header(headers: Column, name: str) -> Column:
    """Header value with '' as default, stripped."""
    return F.coalesce(strip(F.try_element_at(headers, F.lit(name))), F.lit(""))


def is_attachment(disposition: Column) -> Column:
    """Case-sensitive on purpose; a part without the header is not an attachment."""
    return F.coalesce(disposition.contains("attachment"), F.lit(False))


def decode_utf8(payload: Column) -> Column:
    """Bytes as UTF-8 text; bytes that are not UTF-8 are dropped."""
    text = payload.cast("string")
    dropped = F.replace(F.make_valid_utf8(text), F.lit(REPLACEMENT), F.lit(""))
    return F.when(F.is_valid_utf8(text), text).otherwise(dropped)


def body_text(content_type: Column, payload: Column) -> Column:
    """Text of a chosen part: decoded, and converted where it is HTML."""
    decoded = decode_utf8(payload)
    return F.when(content_type == HTML, wrap_lines(html_to_text(decoded))).otherwise(decoded)


def is_candidate(content_type: Column, disposition: Column, multipart: Column) -> Column:
    """Whether a part can be the body; attachments are ruled out in multipart messages only."""
    return content_type.isin(PLAIN, HTML) & ~(multipart & is_attachment(disposition))


def preference(content_type: Column, part_no: Column) -> Column:
    """Smaller is better: plain text before HTML, then part order."""
    return F.when(content_type == HTML, F.lit(1 << 40)).otherwise(F.lit(0)) + part_no.cast("long")


def chosen_part(parts: Column, multipart: Column) -> Column:
    """Best part of a nested ``parts`` array, NULL if there is none: no shuffle."""
    ranked = F.transform(
        F.filter(
            parts,
            lambda p: p["payload"].isNotNull()
            & is_candidate(p["content_type"], p["disposition"], multipart),
        ),
        lambda p: F.struct(
            preference(p["content_type"], p["part_no"]).alias("rank"),
            p["content_type"].alias("content_type"),
            p["payload"].alias("payload"),
        ),
    )
    return F.array_min(ranked)
