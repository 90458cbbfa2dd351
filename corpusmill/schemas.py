"""Table schemas, declared once; readers never infer them."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

_TYPES = {
    "bigint": LongType(),
    "boolean": BooleanType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "string": StringType(),
}


def _table(columns: str) -> StructType:
    schema = StructType()
    for column in columns.split(", "):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema


FILES = _table("path string, ext string, ext_rank int, n_bytes bigint, content string")
RAW_RECORDS = _table(
    "ext_rank int, source_path string, pos int, type string, "
    "module_name string, title string, content string"
)
CHUNKS_LABELED = _table(
    "ext_rank int, source_path string, pos int, type string, module_name string, "
    "title string, content string, domain string, contains_assertion boolean, "
    "contains_register_map boolean, n_chars int"
)
PAIRS = _table(
    "task_type string, instruction string, input string, output string, source string, "
    "source_path string, transform_applied string, lint_status string"
)
PREFERENCE_PAIRS = _table("prompt string, chosen string, rejected string")
BENCHMARK = _table(
    "item_id bigint, task_type string, instruction string, input string, reference string"
)
PREDICTIONS = _table(
    "tag string, item_id bigint, prediction string, n_tokens_total bigint, elapsed_s double"
)
RESULTS = _table(
    "task_type string, prediction string, tok_per_sec double, rouge_l double, "
    "compiles boolean, tag string"
)
LINT_RESULTS = _table("code_sha string, ok boolean")
COMPLETIONS = _table("prompt_key string, completion string")
SOURCES = _table("repository string, url string, license string")
