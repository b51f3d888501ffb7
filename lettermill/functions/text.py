"""Text primitives: strip, words, lines, substring counts, display cuts.

Everything here is a plain built-in expression, so it stays inside whole-stage
code generation and can be fused with the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lettermill.functions.fixed_values import PHRASE_CHARS, WHITESPACE

# White space in a regex character class, to be used under (?U), and the white
# space that does not end a line. Listing the characters one by one instead
# makes Java match several times slower.
WS = r"\s\x1c-\x1f"
HS = rf"[{WS}&&[^\n]]"

# A word character is a letter, a number or an underscore. Written out because
# the meaning of \b on accented text differs between regex engines.
WORD = r"\p{L}\p{N}_"
PLAIN_WORD = rf"(?<![{WORD}])[a-z]{{3,}}(?![{WORD}])"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def lstrip(text: Column) -> Column:
    return F.ltrim(text, F.lit(WHITESPACE))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def word_count(text: Column) -> Column:
    """Number of white-space separated words.

    Every word with the space after it becomes one character, so the length of
    the result is the count: one pass, no array of words.
    """
    return F.length(F.regexp_replace(lstrip(text), rf"(?U)[^{WS}]++[{WS}]*+", "w"))


def count_substring(text: Column, needle: str) -> Column:
    """Non-overlapping occurrences of ``needle``: grow each hit by one byte.

    Byte lengths are stored with the string; character lengths would be counted.
    """
    grown = F.replace(text, F.lit(needle), F.lit(needle + "+"))
    return F.octet_length(grown) - F.octet_length(text)


def count_substrings(text: Column, needles: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [count_substring(text, n) for n in needles])


def contains_any(text: Column, needles: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(n) for n in needles])


def ellipsize(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def first_line(text: Column, n: int = PHRASE_CHARS) -> Column:
    """First line of the stripped text, stripped, first ``n`` characters."""
    return F.left(strip(F.substring_index(strip(text), "\n", 1)), F.lit(n))


def last_line(text: Column, n: int = PHRASE_CHARS) -> Column:
    """Last non-blank line, stripped, first ``n`` characters.

    The stripped text ends in a non-blank character, so what follows its last
    line break is the last non-blank line.
    """
    return F.left(strip(F.substring_index(strip(text), "\n", -1)), F.lit(n))


def plain_words(text: Column) -> Column:
    """Array of the lower-case words of three or more plain letters a-z."""
    return F.regexp_extract_all(F.lower(text), F.lit(PLAIN_WORD), F.lit(0))


def words(text: Column) -> Column:
    """Array of lower-case runs of word characters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"[{WORD}]+"), F.lit(0))
