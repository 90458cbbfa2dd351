"""Files to records: code modules and documentation sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.fixed_values import (
    CODE_EXTENSIONS,
    TYPE_FILE,
    TYPE_MODULE,
    TYPE_SECTION,
    WORD,
    WS,
)
from corpusmill.functions.lexical import mask, spans
from corpusmill.functions.text import strip
from corpusmill.schemas import RAW_RECORDS

# The look-arounds are word boundaries for any script. Behind their literal they
# run only where it was found.
_MODULE = (
    rf"(?s)module(?<!{WORD}module){WS}+{WORD}+.*?"
    rf"endmodule(?<!{WORD}endmodule)(?!{WORD})"
)
_MODULE_NAME = rf"module{WS}+({WORD}+)"
# (?d): only a line feed ends a line.
_HEADING = rf"(?md)^(#{{1,4}}{WS}.+)$"
# Behind the last closing word no module can end; searching on would be quadratic.
_TO_LAST_END = rf"(?s)\A.*endmodule(?<!{WORD}endmodule)(?!{WORD})"


def _is_code() -> Column:
    return F.col("ext").isin(*CODE_EXTENSIONS)


def _modules(text: Column) -> Column:
    found = F.regexp_extract_all(F.regexp_extract(text, _TO_LAST_END, 0), F.lit(_MODULE), 0)
    return F.when(text.contains("endmodule"), found).otherwise(F.array().cast("array<string>"))


def _piece(kind: str, heading: Column, body: Column, name: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), heading.alias("heading"), body.alias("body"), name.alias("name"))


def _masked_modules(text: Column) -> Column:
    """Pieces of the modules whose first and last word stand in code."""
    painted = F.when(text.contains("endmodule"), F.regexp_extract(mask(text), _TO_LAST_END, 0)).otherwise("")
    head = rf"\Amodule{WS}+"

    def piece(span: Column, code: Column) -> Column:
        body, start = F.substring(text, span["start"], span["size"]), F.substring(code, span["start"], span["size"])
        before, name = F.regexp_extract(start, head, 0), F.regexp_extract(start, rf"{head}({WORD}+)", 1)
        own = F.substring(body, F.length(before) + 1, F.length(name))
        return _piece(TYPE_MODULE, F.lit(None).cast("string"), body, F.ltrim(own, F.lit("\\")))

    # An array of one element, so that the mask is painted once and not for each module.
    each = F.transform(F.array(painted), lambda code: F.transform(spans(code, _MODULE), lambda span: piece(span, code)))
    return F.get(each, F.lit(0))


def _pieces(text: Column, masked: bool) -> Column:
    """Array of (type, heading, body, name): modules without heading, or what stands at and after headings."""
    none = F.lit(None).cast("string")
    headings = F.concat(F.array(none), F.regexp_extract_all(text, F.lit(_HEADING), 1))
    sections = F.zip_with(headings, F.split(text, _HEADING, -1), lambda heading, body: _piece(TYPE_SECTION, heading, body, none))
    if masked:
        modules = _masked_modules(text)
    else:
        modules = F.transform(_modules(text), lambda m: _piece(TYPE_MODULE, none, m, F.regexp_extract(m, _MODULE_NAME, 1)))
    return F.when(_is_code(), modules).otherwise(sections)


def raw_records(files: DataFrame, masked: bool = False) -> DataFrame:
    """All records of all files in one pass over the files.

    Code files give one row per module, or one whole-file row if there is none.
    Documentation gives the text before the first heading and one row per
    heading. (ext_rank, source_path, pos) is the total order of the records.

    With `masked`, words in comments, strings and escaped names neither begin nor
    end a module, and its name is the one after its first word, escaped or not.
    """
    text = F.col("content")
    found = files.select("ext_rank", "ext", F.col("path").alias("source_path"), "content", _pieces(text, masked).alias("pieces"))
    # Only a file without modules is carried along whole.
    is_whole = _is_code() & (F.size("pieces") == 0)
    none = F.lit(None).cast("string")
    whole = F.array(_piece(TYPE_FILE, none, strip(text), none))
    # The type comes out of the pieces: a filter on it stays above the parsing, which
    # Spark would else repeat in the few tasks that scan the files.
    kind = F.col("piece.type")
    rows = found.select(
        "ext_rank",
        "ext",
        "source_path",
        F.posexplode(F.when(is_whole, whole).otherwise(F.col("pieces"))).alias("pos", "piece"),
    )
    heading, body = strip(F.col("piece.heading")), F.col("piece.body")
    section = strip(F.concat_ws("\n\n", heading, strip(body)))
    records = rows.select(
        "ext_rank",
        "source_path",
        "pos",
        kind.alias("type"),
        F.when(kind == TYPE_MODULE, F.nullif(F.col("piece.name"), F.lit(""))).alias("module_name"),
        F.when(~_is_code(), heading).alias("title"),
        F.when(_is_code(), body).otherwise(section).alias("content"),
    )
    # An empty code file still gives its row; an empty section gives none.
    keep = (F.col("type") != TYPE_SECTION) | (F.col("content") != "")
    return records.filter(keep).select(RAW_RECORDS.fieldNames())


def sv_modules(files: DataFrame, masked: bool = False) -> DataFrame:
    return raw_records(files.filter(_is_code()), masked)


def md_sections(files: DataFrame) -> DataFrame:
    return raw_records(files.filter(~_is_code()))
