"""A lexical mask of source code: the same text with whatever is no code painted over.

Comments become spaces, string literals quotation marks and escaped names
underscores, each of equal length. So a keyword found in the mask is a keyword of
the code, and places in the mask are places in the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A line comment, a block comment, a string literal, an escaped name. What is not
#: closed runs to the end of its line or, for a block comment, of the text.
LEXEMES = r'//[^\n]*+|/\*(?s:.*?)(?:\*/|\z)|"[^"\\\n]*+(?:\\(?s:.)[^"\\\n]*+)*+"?|\\\S++'


def _paint(lexeme: Column) -> Column:
    fill = F.when(lexeme.startswith("/"), " ").when(lexeme.startswith('"'), '"').otherwise("_")
    return F.repeat(fill, F.length(lexeme))


def mask(code: Column) -> Column:
    """`code` with comments, strings and escaped names painted over; null stays null."""
    between = F.split(code, LEXEMES, -1)
    painted = F.concat(F.transform(F.regexp_extract_all(code, F.lit(LEXEMES), 0), _paint), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, painted, lambda gap, fill: F.concat(gap, fill)), "")


def spans(text: Column, pattern: str) -> Column:
    """array<struct<start, size>>: where the matches of `pattern` stand, in characters from 1."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), F.length)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    both = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("size"))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,size:int>>").alias("spans"))

    def add(state: Column, each: Column) -> Column:
        at = state["at"] + each["gap"]
        span = F.struct(at.alias("start"), each["size"].alias("size"))
        return F.struct((at + each["size"]).alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    return F.aggregate(both, start, add, lambda state: state["spans"])
