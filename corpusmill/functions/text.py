"""String columns whose meaning matches Python's on any Unicode text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.fixed_values import CODE_BLOCK, WS

# All white-space characters, from the Unicode property rather than by hand.
STRIP_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(text: Column) -> Column:
    """str.strip(): linear, unlike an anchored regex on long white-space runs."""
    return F.btrim(text, F.lit(STRIP_CHARS))


def normalize(text: Column) -> Column:
    """Lower case, white-space runs to one space, trimmed."""
    return F.btrim(F.regexp_replace(F.lower(text), f"{WS}+", " "), F.lit(" "))


def contains_any(text: Column, marks: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for mark in marks:
        hit = hit | text.contains(mark)
    return hit


def replace_first(text: Column, pattern: str, replacement: str) -> Column:
    """Replace only the leftmost match: the anchor lets the pattern match once."""
    return F.regexp_replace(text, rf"(?s)\A(.*?)(?:{pattern})", F.lit("$1" + replacement))


def code_blocks(text: Column) -> Column:
    """Every fenced block's body, in order."""
    return F.regexp_extract_all(text, F.lit(CODE_BLOCK), 1)


def first_code(text: Column) -> Column:
    """The first fenced block, or the whole text when there is none."""
    return F.coalesce(F.try_element_at(code_blocks(text), F.lit(1)), text)


def content_sha(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x01", *parts), 256)
