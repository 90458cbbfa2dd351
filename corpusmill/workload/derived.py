"""Inputs derived from the given tables, as SQL that Spark and DuckDB both run.

The given tables hold no source code, pairs or completions, so these selects
build them row by row from integer and string columns. They grow with the
tables: one code file per part, one documentation file per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.sources.files import with_extension
from corpusmill.sources.tables import load_table, spread

NL = "chr(10)"
QUOTE = "chr(39)"
FENCE = "repeat(chr(96), 3)"
P = "CAST(p_partkey AS STRING)"
P_FAMILY = "CAST(p_partkey - p_partkey % 64 AS STRING)"


def _lines(*parts: str) -> str:
    return "concat(" + ", ".join(parts) + f", {NL})"


_COMPARE = _lines("'  assign hit = (q == 8'", QUOTE, "'d'", "CAST(p_partkey % 50 AS STRING)", "');'")
_CASE_EQ = _lines("'  always @(*) if (q === 8'", QUOTE, "'d3) hit = 1;'")
_COUNT = _lines("'  always @(posedge clk) q <= q +  1'", QUOTE, "'b1;'")
_RESET = _lines("'  always @(posedge clk) if ( !rst_n ) q <= 0;'")
_PLAIN = _lines("'  assign q = 0;'")
_ASSERT = _lines(
    "'  assert property (@(posedge clk) q < 200);'", NL, "'  assert property (@(posedge clk)'", NL,
    "'    hit |-> q);'",
)


def _module(m: int) -> str:
    return f"""concat('module p', {P}, '_{m} (input clk, input rst_n, output reg q);', {NL},
      CASE (p_partkey + {m}) % 7
        WHEN 0 THEN {_COMPARE} WHEN 1 THEN {_CASE_EQ} WHEN 2 THEN {_COUNT} WHEN 3 THEN {_RESET}
        WHEN 4 THEN concat({_COMPARE}, {_COUNT}, {_RESET}) WHEN 5 THEN {_PLAIN}
        ELSE {_ASSERT} END,
      CASE WHEN p_partkey % 17 = 0 THEN {_lines("'  // `uvm_info'")} ELSE '' END,
      CASE WHEN p_partkey % 19 = 0 THEN {_lines("'  // Register Map, OFFSET 0x10'")} ELSE '' END,
      repeat(concat('  // ', p_name, {NL}), CASE WHEN p_partkey % 11 = 0 THEN p_size * 20 ELSE p_size END),
      'endmodule', {NL})"""


CODE_FILES = f"""
  SELECT concat('repo', CAST(p_partkey % 7 AS STRING), '/rtl/m', {P},
           CASE p_partkey % 10 WHEN 1 THEN '.v' WHEN 2 THEN '.svh' ELSE '.sv' END) AS path,
         CASE WHEN p_partkey % 13 = 0
           THEN concat({NL}, '  class c', {P}, ' extends uvm_component;', {NL}, 'endclass', {NL})
           ELSE concat('// ', p_name, {NL}, {_module(1)},
             CASE WHEN p_partkey % 3 > 0 THEN concat(
               CASE WHEN p_partkey % 23 = 0 THEN '// next module' ELSE '// next' END, {NL}, {_module(2)})
               ELSE '' END,
             CASE WHEN p_partkey % 3 = 2 THEN {_module(3)} ELSE '' END)
         END AS content
  FROM part"""

# Words that would begin or end a module, in comments, strings and escaped names.
_BS, _DQ = "chr(92)", "chr(34)"
_FORGED = (
    _lines("'// module before; endmodule'"),
    _lines("'/* module'", NL, "'endmodule */ wire a;'"),
    _lines(f"'  initial $display(', {_DQ}, 'endmodule ', {_BS}, {_DQ}, ' // no comment endmodule', {_DQ}, ');'"),
    _lines(f"'  wire ', {_BS}, 'endmodule ; // endmodule'"),
    _lines(f"'  // ', {_DQ}, ' not a string'"),
    _lines(f"'  string s = ', {_DQ}, 'open /* endmodule'"),
    _lines("'  assign b = a / 2; /* endmodule **/'"),
)


def _forged(shift: int) -> str:
    return f"CASE (p_partkey + {shift}) % 7 " + " ".join(f"WHEN {i} THEN {line}" for i, line in enumerate(_FORGED)) + " END"


FORGED_FILES = f"""
  SELECT concat('repo', CAST(p_partkey % 7 AS STRING), '/forged/m', {P}, '.sv') AS path,
         concat({_forged(0)}, 'module /* module x; */ ',
           CASE WHEN p_partkey % 5 = 0 THEN concat({_BS}, 'odd+endmodule') ELSE concat('m', {P}) END,
           ' (input a);', {NL}, {_forged(1)}, {_forged(2)}, {_forged(3)}, 'endmodule', {NL}, {_forged(4)},
           CASE WHEN p_partkey % 3 = 0 THEN {_module(1)} ELSE '' END, {_forged(5)},
           CASE WHEN p_partkey % 11 = 0 THEN '/* module late; endmodule' ELSE '' END) AS content
  FROM part"""

# Some folders and files have names that scans often pass over, and some texts hold
# noncharacters and a genuine replacement character.
DOC_FILES = f"""
  SELECT concat(CASE doc_id % 16 WHEN 3 THEN '.hidden-' WHEN 5 THEN '_docs-' ELSE 'docs-' END, source, '/',
           CASE doc_id % 20 WHEN 1 THEN '_' WHEN 2 THEN '.' ELSE '' END, 'd', CAST(doc_id AS STRING),
           CASE WHEN doc_id % 4 = 0 THEN '.rst' ELSE '.md' END) AS path,
         concat(text, CASE WHEN doc_id % 9 = 0 THEN '\ufdd0\ufdd1\ufdd2\ufffd' ELSE '' END, {NL}, '# Notes on ', source, {NL}, 'Length ', CAST(n_chars AS STRING), {NL},
           '##### not a heading', {NL},
           CASE WHEN doc_id % 3 = 0 THEN concat('## Empty', {NL}) ELSE '' END,
           '#', {NL}, '## Part B ', CAST(doc_id AS STRING), {NL}, 'tail ', lang, {NL}) AS content
  FROM documents"""

# One row per part. A third of the rows share one source file.
PAIRS = f"""
  SELECT p_partkey AS pair_id,
         CASE p_partkey % 4 WHEN 0 THEN 'sva_assertion_generation' WHEN 1 THEN 'rtl_bug_finding'
           WHEN 2 THEN 'rtl_explanation' ELSE 'rtl_generation' END AS task_type,
         concat('Work on the ', p_name, ' block.') AS instruction,
         {_module(1)} AS input,
         CASE p_partkey % 5
           WHEN 0 THEN concat('{chr(32)}', {_ASSERT}, 'done')
           WHEN 1 THEN concat('Code:', {NL}, {FENCE}, 'systemverilog', {NL}, {_module(2)}, {FENCE}, {NL}, 'end')
           WHEN 2 THEN concat({FENCE}, {NL}, {_ASSERT}, {FENCE})
           WHEN 3 THEN concat({FENCE}, {NL}, 'wire w', CAST(p_partkey % 9 AS STRING), ';', {NL}, {FENCE}, ' and ',
             {FENCE}, 'systemverilog', {NL}, {_PLAIN}, {_module(3)}, {FENCE})
           ELSE concat('lbl: assert property (x', CAST(p_size AS STRING), ');') END AS output,
         CASE WHEN p_partkey % 3 = 0 THEN 'repo0/rtl/shared.sv' WHEN p_partkey % 7 = 1 THEN NULL
           WHEN p_partkey % 7 = 2 THEN ''
           ELSE concat('repo', CAST(p_brand AS STRING), '/rtl/m',
             CAST(CAST((p_partkey - p_partkey % 5) / 5 AS BIGINT) AS STRING), '.sv') END AS source_path
  FROM part"""

# Pairs about documents, of which many are near-copies of others from other sources.
DOCUMENT_PAIRS = """
  SELECT doc_id AS pair_id, 'rtl_explanation' AS task_type, 'Explain.' AS instruction, text AS input, lang AS output,
         CASE WHEN doc_id % 7 = 0 THEN NULL
              ELSE concat(source, '/f', CAST(doc_id % 100 - doc_id % 4 AS STRING)) END AS source_path
  FROM documents"""

# The user turn asks, the next assistant turn answers; unanswered calls have no row.
PREDICTIONS = f"""
  SELECT role AS tag, conv_id % 40 AS item_id,
         CASE WHEN conv_id % 3 = 0 THEN concat(text, {NL}, {FENCE}, 'systemverilog', {NL},
                'module c', CAST(conv_id % 10 AS STRING), '; ',
                CASE WHEN turn % 2 = 0 THEN 'assert property (x);' ELSE '' END, {NL}, 'endmodule', {NL}, {FENCE})
              ELSE text END AS prediction,
         CAST(length(text) AS BIGINT) AS n_tokens_total,
         CAST(turn AS DOUBLE) * 0.5e0 AS elapsed_s
  FROM conversations"""

BENCHMARK = """
  SELECT item_id,
         CASE item_id % 3 WHEN 0 THEN 'rtl_explanation' WHEN 1 THEN 'sva_assertion_generation'
           ELSE 'rtl_bug_finding' END AS task_type,
         concat('Describe item ', CAST(item_id AS STRING), '.') AS instruction,
         text AS input,
         CASE item_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END AS reference
  FROM benchmark"""

# A checker's verdict by code length: unknown, failed or passed; some never ran.
LINT_VERDICT = """CASE WHEN length(code) % 5 = 0 THEN NULL WHEN length(code) % 5 = 1 THEN false ELSE true END"""
LINT_RAN = "length(code) % 7 <> 3"
LINT_AGAIN = "length(code) % 11 = 0"  # a second outcome: failed

# Bytes that are no UTF-8 are written into these files, at their end.
BAD_BYTES = b"\xff\xc3"
HAS_BAD_BYTES = "path LIKE '%7.md'"

# Beside these files stands a link of this ending that leads nowhere.
HAS_LOST_TWIN = "path LIKE '%3.md'"
LOST_END = ".lost.md"
# Larger files are left out where a limit is asked for.
MAX_BYTES = 12_000

MARKED_RECORDS = """
  SELECT doc_id, concat(text, CASE WHEN doc_id % 10 = 3 THEN '<|endofdoc|>' ELSE '' END) AS content
  FROM documents"""

RECORDS_FROM_DOCUMENTS = "SELECT doc_id, text AS content, source AS source_path, 'md_section' AS type FROM documents"


# Families of 64 records whose texts drift: each is the one before it, moved on by
# twelve characters, so that only neighbours in a row are near.
_LONG = "concat(" + ", ".join(f"md5(concat({P_FAMILY}, '|{{}}'))".format(i) for i in range(44)) + ")"
DRIFTING_RECORDS = f"""
  SELECT p_partkey AS doc_id, substr({_LONG}, CAST(1 + 12 * (p_partkey % 64) AS INTEGER), 600) AS content,
         concat('family', {P_FAMILY}) AS source_path
  FROM part"""

#: The batch in which a document comes.
BATCH = "CAST(doc_id % 3 AS INTEGER)"
BATCHED_RECORDS = f"SELECT doc_id, text AS content, {BATCH} AS batch FROM documents"


def select(spark: SparkSession, folder: str, table: str, sql: str) -> DataFrame:
    """Run one of the selects above on a given table.

    A few-kilobyte table can turn into many megabytes of text here, so a scan
    with fewer tasks than cores is spread first.
    """
    source = load_table(spark, folder, table)
    source = spread(source, source.columns[0])
    return spark.sql(sql.replace(f"FROM {table}", "FROM {source}"), source=source)


def code_files(spark: SparkSession, folder: str) -> DataFrame:
    return _as_files(select(spark, folder, "part", CODE_FILES))


def forged_files(spark: SparkSession, folder: str) -> DataFrame:
    return _as_files(select(spark, folder, "part", FORGED_FILES))


def doc_files(spark: SparkSession, folder: str) -> DataFrame:
    return _as_files(select(spark, folder, "documents", DOC_FILES))


def files(spark: SparkSession, folder: str) -> DataFrame:
    return code_files(spark, folder).union(doc_files(spark, folder))


def _as_files(rows: DataFrame) -> DataFrame:
    sized = with_extension(rows).withColumn("n_bytes", F.octet_length("content").cast("bigint"))
    return sized.select("path", "ext", "ext_rank", "n_bytes", "content")


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    return select(spark, folder, "part", PAIRS)


def document_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return select(spark, folder, "documents", DOCUMENT_PAIRS)


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return select(spark, folder, "conversations", PREDICTIONS)


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return select(spark, folder, "benchmark", BENCHMARK)


def document_records(spark: SparkSession, folder: str) -> DataFrame:
    return select(spark, folder, "documents", RECORDS_FROM_DOCUMENTS)


def drifting_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = select(spark, folder, "part", DRIFTING_RECORDS)
    # Through a generator, which no filter is pushed below: a filter on the texts
    # would make them a second time, in the one or two tasks that scan the table.
    return rows.select("doc_id", F.explode(F.array("content")).alias("content"), "source_path")


def batched_records(spark: SparkSession, folder: str) -> DataFrame:
    return select(spark, folder, "documents", BATCHED_RECORDS)


def marked_records(spark: SparkSession, folder: str) -> DataFrame:
    return select(spark, folder, "documents", MARKED_RECORDS)


def lint_results(codes: DataFrame) -> DataFrame:
    """The outcome table for a table of code blocks (`code`); some were checked twice."""
    ran = codes.filter(LINT_RAN)
    outcomes = f"CASE WHEN {LINT_AGAIN} THEN array({LINT_VERDICT}, false) ELSE array({LINT_VERDICT}) END"
    return ran.selectExpr("sha2(code, 256) AS code_sha", f"explode({outcomes}) AS ok").distinct()
