"""DuckDB SQL for the registered queries, over whole tables and whole texts.

The selects in `derived` are the common inputs. Everything after them is
written for DuckDB alone, from the definition of each operator.
"""

from __future__ import annotations

from corpusmill import fixed_values as fv
from corpusmill.functions.sketch import EMPTY, MIX, MULTIPLIERS
from corpusmill.functions.text import STRIP_CHARS
from corpusmill.sources.seeds import DEFAULT_SEEDS
from corpusmill.workload import derived as d

_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_BLOCKS = r"(?s)```(?:systemverilog)?\n(.*?)\n```"
_TWO_32 = 2**32


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip(expr: str) -> str:
    return f"trim({expr}, {_quote(STRIP_CHARS)})"


def _normalize(expr: str) -> str:
    return f"trim(regexp_replace(lower({expr}), '{_WS}+', ' ', 'g'), ' ')"


def _query(*ctes: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


# ---- common inputs ----------------------------------------------------------
_EXT_RANK = (
    "CASE ext " + " ".join(
        f"WHEN '{e}' THEN {i}" for i, e in enumerate(fv.CODE_EXTENSIONS + fv.DOC_EXTENSIONS)
    ) + " END"
)
FILES = f"""files AS (
  SELECT path, ext, CAST({_EXT_RANK} AS INTEGER) AS ext_rank, strlen(content) AS n_bytes, content
  FROM (SELECT path, regexp_extract(path, '[.]([a-z]+)$', 1) AS ext, content
        FROM ({d.CODE_FILES} UNION ALL {d.DOC_FILES})))"""

_SIZE_ON_DISK = f"n_bytes + CASE WHEN {d.HAS_BAD_BYTES} THEN {len(d.BAD_BYTES)} ELSE 0 END"

# Code: every module, else the whole file. Documents: cut at the headings.
RECORDS = rf"""mods AS (
  SELECT *, regexp_extract_all(content, '(?s)\bmodule\s+\w+.*?\bendmodule\b') AS found
  FROM files WHERE ext_rank <= 2),
code_rows AS (
  SELECT ext_rank, path, len(found) > 0 AS has_module,
         unnest(CASE WHEN len(found) > 0 THEN found ELSE [{_strip('content')}] END) AS content,
         generate_subscripts(CASE WHEN len(found) > 0 THEN found ELSE [''] END, 1) - 1 AS pos
  FROM mods),
cut AS (
  SELECT ext_rank, path,
         string_split(regexp_replace(content, '(?m)^(#{{1,4}}{_WS}.+)$', chr(1) || '\1' || chr(2), 'g'), chr(1)) AS parts
  FROM files WHERE ext_rank > 2),
doc_parts AS (
  SELECT ext_rank, path, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS pos FROM cut),
doc_rows AS (
  SELECT ext_rank, path, pos,
         CASE WHEN pos > 0 THEN {_strip("split_part(part, chr(2), 1)")} END AS title,
         {_strip("CASE WHEN pos > 0 THEN split_part(part, chr(2), 2) ELSE part END")} AS body
  FROM doc_parts),
records AS (
  SELECT ext_rank, path AS source_path, CAST(pos AS INTEGER) AS pos,
         CASE WHEN has_module THEN 'sv_module' ELSE 'sv_file' END AS type,
         CASE WHEN has_module THEN regexp_extract(content, 'module\s+(\w+)', 1) END AS module_name,
         CAST(NULL AS VARCHAR) AS title, content
  FROM code_rows
  UNION ALL
  SELECT ext_rank, path, CAST(pos AS INTEGER), 'md_section', NULL, title,
         CASE WHEN title IS NULL THEN body WHEN body = '' THEN title ELSE title || chr(10) || chr(10) || body END
  FROM doc_rows WHERE title IS NOT NULL OR body <> '')"""

_LEXEMES = r'//[^\n]*|/\*(?s:.*?)(?:\*/|\z)|"(?:\\(?s:.)|[^"\\\n])*"?|\\\S+'
_MASKED_MODULE = r"(?s)\bmodule\s+\w+.*?\bendmodule\b"
MASKED = rf"""files AS (SELECT path, content FROM ({d.FORGED_FILES})),
painted AS (
  SELECT path, content, array_to_string(list_transform(
           list_zip(regexp_split_to_array(content, '{_LEXEMES}'), regexp_extract_all(content, '{_LEXEMES}')),
           lambda x: x[1] || repeat(CASE WHEN starts_with(x[2], '/') THEN ' ' WHEN starts_with(x[2], '"') THEN '"' ELSE '_' END,
                                    coalesce(length(x[2]), 0))), '') AS code
  FROM files),
pieces AS (
  SELECT path, content, code, unnest(regexp_extract_all(code, '{_MASKED_MODULE}')) AS found,
         unnest(regexp_split_to_array(code, '{_MASKED_MODULE}')) AS gap,
         generate_subscripts(regexp_split_to_array(code, '{_MASKED_MODULE}'), 1) AS k
  FROM painted),
placed AS (
  SELECT *, length(found) AS size, sum(length(gap) + coalesce(length(found), 0)) OVER (PARTITION BY path ORDER BY k)
           - coalesce(length(found), 0) + 1 AS start FROM pieces),
records AS (
  SELECT path, k - 1 AS pos, 'sv_module' AS type,
         ltrim(substr(substr(content, CAST(start AS BIGINT), size), length(regexp_extract(found, '^module\s+')) + 1,
                      length(regexp_extract(found, '^module\s+(\w+)', 1))), chr(92)) AS module_name,
         substr(content, CAST(start AS BIGINT), size) AS content
  FROM placed WHERE found IS NOT NULL
  UNION ALL
  SELECT path, 0, 'sv_file', NULL, {_strip('content')} FROM placed WHERE k = 1 AND found IS NULL)"""

LABELED = """labeled AS (
  SELECT *,
         CASE WHEN contains(content, 'uvm_component') OR contains(content, 'uvm_sequence')
                OR contains(content, '`uvm_') THEN 'uvm'
              WHEN type IN ('sv_module', 'sv_file') THEN 'rtl' ELSE 'doc' END AS domain,
         contains(content, 'assert property') OR contains(content, 'assume property') AS contains_assertion,
         contains(lower(content), 'register map') OR contains(lower(content), 'reg_map')
           OR contains(lower(content), 'offset 0x') AS contains_register_map,
         CAST(length(content) AS INTEGER) AS n_chars
  FROM records)"""

DOCUMENTS = f"docs AS ({d.RECORDS_FROM_DOCUMENTS})"
# All parsed records as `docs`, numbered in record order.
NUMBERED = (
    "docs AS (SELECT row_number() OVER (ORDER BY ext_rank, source_path, pos) AS doc_id, * FROM records{0})"
)
# Documents in the order of their batches, then of their ids.
BATCHED = (
    "docs AS (SELECT row_number() OVER (ORDER BY batch, doc_id) AS doc_id, doc_id AS own_id, content, batch"
    f" FROM ({d.BATCHED_RECORDS}))"
)
PAIRS = f"pairs_in AS ({d.PAIRS})"
PREDICTIONS = f"predictions AS ({d.PREDICTIONS})"
BENCHMARK = f"bench AS ({d.BENCHMARK})"


def _first_code(expr: str) -> str:
    return f"coalesce(regexp_extract_all({expr}, '{_BLOCKS}', 1)[1], {expr})"


def _lint_table(codes: str) -> str:
    return f"""lint AS (
  SELECT sha256(code) AS code_sha,
         CASE WHEN NOT bool_or({d.LINT_VERDICT} IS NULL) THEN bool_and({d.LINT_VERDICT} AND NOT {d.LINT_AGAIN}) END AS ok
  FROM ({codes}) WHERE {d.LINT_RAN} GROUP BY 1)"""


# ---- near-duplicates --------------------------------------------------------
def _mix_steps() -> list[str]:
    steps, source = [], "windows"
    for i in range(1, 6):
        steps.append(
            f"mul{i} AS (SELECT * REPLACE ((xor(x, c{i}) * {MIX}) % {_TWO_32} AS x) FROM {source})"
        )
        steps.append(f"mix{i} AS (SELECT * REPLACE (xor(x, x >> 15) AS x) FROM mul{i})")
        source = f"mix{i}"
    return steps


_MINIMA = ", ".join(
    f"coalesce(min(({a} * x) % {_TWO_32}) >> 1, {EMPTY}) AS s{k}" for k, a in enumerate(MULTIPLIERS)
)
_BANDS = ", ".join(
    f"md5('{band}|' || concat_ws(',', " + ", ".join(f"s{band * 16 + i}" for i in range(16)) + "))"
    for band in range(fv.BANDS)
)
SIGNATURES = ",\n".join(
    [
        f"texts AS (SELECT doc_id, {_normalize('content')} AS t FROM docs WHERE length(content) >= 50)",
        "chars AS (SELECT doc_id, unnest(string_split(t, '')) AS c,"
        " generate_subscripts(string_split(t, ''), 1) AS p FROM texts)",
        "windows AS (SELECT doc_id, CAST(0 AS BIGINT) AS x, CAST(unicode(c) AS BIGINT) AS c1, "
        + ", ".join(f"lead(unicode(c), {i}) OVER w AS c{i + 1}" for i in range(1, 5))
        + " FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY p) QUALIFY c5 IS NOT NULL)",
        *_mix_steps(),
        f"sigs AS (SELECT texts.doc_id, {_MINIMA} FROM texts LEFT JOIN mix5 USING (doc_id) GROUP BY texts.doc_id)",
        f"banded AS (SELECT doc_id, unnest([{_BANDS}]) AS bucket, unnest(range(8)) AS band FROM sigs)",
    ]
)
# The sequential rule as states that advance together: a record is decided once
# all its earlier candidates are.
GREEDY = """edges AS MATERIALIZED (
  SELECT DISTINCT a.doc_id AS i, b.doc_id AS j
  FROM banded a JOIN banded b ON a.bucket = b.bucket AND a.doc_id < b.doc_id),
walk AS (
  SELECT 0 AS step, doc_id, CASE WHEN doc_id IN (SELECT j FROM edges) THEN 'open' ELSE 'kept' END AS state
  FROM texts
  UNION ALL
  SELECT w.step + 1, w.doc_id,
         CASE WHEN w.state <> 'open' THEN w.state
              WHEN EXISTS (SELECT 1 FROM edges e JOIN walk k ON k.doc_id = e.i
                           WHERE e.j = w.doc_id AND k.state = 'kept') THEN 'removed'
              WHEN NOT EXISTS (SELECT 1 FROM edges e JOIN walk k ON k.doc_id = e.i
                               WHERE e.j = w.doc_id AND k.state = 'open') THEN 'kept'
              ELSE 'open' END
  FROM walk w WHERE EXISTS (SELECT 1 FROM walk WHERE state = 'open')),
kept AS (SELECT docs.* FROM docs JOIN walk USING (doc_id)
         WHERE state = 'kept' AND step = (SELECT max(step) FROM walk))"""

# ---- pairs ------------------------------------------------------------------
_FLIP = "regexp_replace({0}, '==([^=]|$)', '!=\\1')"
_OFF = "regexp_replace({0}, '\\+\\s*1''b1', '+ 2''b10')"
_RESET = "regexp_replace({0}, 'if\\s*\\(\\s*!rst_n\\s*\\)', 'if (rst_n)')"
_HITS = {
    "flip_comparison": ("'==([^=]|$)'", _FLIP),
    "off_by_one_increment": ("'\\+\\s*1''b1'", _OFF),
    "invert_reset_polarity": ("'if\\s*\\(\\s*!rst_n\\s*\\)'", _RESET),
}
_RECORD_KEY = "concat(source_path, '#', pos)"
BUG_PAIRS = f"""drawn AS (
  SELECT *, substr(least({", ".join(
      f"CASE WHEN regexp_matches(content, {hit}) THEN md5(concat('42|', {_RECORD_KEY}, '|{name}')) || '{name}' END"
      for name, (hit, _) in _HITS.items())}), 33) AS transform_applied
  FROM records WHERE type = 'sv_module' AND length(content) BETWEEN 40 AND 3000),
bugs AS (
  SELECT 'rtl_bug_finding' AS task_type, {_quote(fv.BUG_INSTRUCTION)} AS instruction,
         CASE transform_applied {" ".join(f"WHEN '{n}' THEN {e.format('content')}" for n, (_, e) in _HITS.items())} END AS input,
         {_quote(fv.BUG_ANSWER_HEAD)} || CASE transform_applied {" ".join(
             f"WHEN '{n}' THEN {_quote(spec['desc'])}" for n, spec in fv.BUG_EDITS.items())} END
           || {_quote(fv.BUG_ANSWER_TAIL)} AS output,
         'mechanical_bug_injection' AS source, source_path, transform_applied
  FROM drawn WHERE transform_applied IS NOT NULL)"""
CANDIDATES = f"""eligible AS (
  SELECT source_path, pos, content FROM records
  WHERE type = 'sv_module' AND length(content) > 100 AND length(content) < 2000),
prompts AS (
  SELECT *, {_quote(fv.EXPLAIN_PROMPT_HEAD)} || content || {_quote(fv.EXPLAIN_PROMPT_TAIL)} AS prompt FROM eligible),
keyed AS (SELECT *, sha256(concat_ws(chr(1), {_RECORD_KEY}, prompt)) AS prompt_key FROM prompts)"""
def _generated(completion: str) -> str:
    return f"""completions AS (
  SELECT prompt_key, {completion} AS completion
  FROM keyed WHERE length(prompt) % 3 > 0),
generated AS (
  SELECT 'rtl_explanation' AS task_type, {_quote(fv.EXPLAIN_INSTRUCTION)} AS instruction, content AS input,
         completion AS output, 'llm_augmented' AS source, source_path
  FROM keyed JOIN completions USING (prompt_key))"""


COMPLETIONS = _generated(
    "CASE WHEN length(prompt) % 5 = 0 THEN 'Another answer.' ELSE 'It is ' || length(prompt) || ' long.' END"
)
ANSWERS_WITH_CODE = _generated(
    "'It is ' || length(prompt) || ' long.' || CASE WHEN length(prompt) % 2 = 0 THEN concat(chr(10), "
    "'```systemverilog', chr(10), 'wire w', repeat('x', length(prompt) % 6), ';', chr(10), '```') ELSE '' END"
)

_SEEDS = ", ".join("(" + ", ".join(map(_quote, row)) + ")" for row in DEFAULT_SEEDS)

# ---- lint -------------------------------------------------------------------
_VERIFY = ", ".join(_quote(t) for t in (*fv.VERIFY_TASKS, fv.TASK_ASSERT))
LINT = f"""fenced AS (
  SELECT pair_id, task_type, output, regexp_extract_all(output, '{_BLOCKS}', 1) AS codes
  FROM pairs_in WHERE task_type IN ({_VERIFY})),
blocks AS (
  SELECT pair_id, unnest(CASE WHEN len(codes) = 0 AND task_type = {_quote(fv.TASK_ASSERT)}
                              THEN [output] ELSE codes END) AS code
  FROM fenced),
{_lint_table("SELECT code FROM blocks")},
folded AS (
  SELECT pair_id, bool_or(ok IS NULL) AS unknown, bool_or(NOT ok) AS failed
  FROM blocks LEFT JOIN lint ON lint.code_sha = sha256(code) GROUP BY pair_id),
linted AS (
  SELECT p.*, CASE WHEN f.pair_id IS NULL THEN 'not_applicable' WHEN unknown THEN 'verilator_unavailable'
                   WHEN failed THEN 'verified_fail' ELSE 'verified_pass' END AS lint_status
  FROM pairs_in p LEFT JOIN folded f USING (pair_id))"""

# ---- split ------------------------------------------------------------------
SPLIT = """keyed_pairs AS (
  SELECT *, coalesce(nullif(source_path, ''), concat('seed::', task_type, '::',
    sha256(concat_ws(chr(1), task_type, instruction, input, output)))) AS split_key FROM pairs_in),
ranked AS (
  SELECT split_key, row_number() OVER (ORDER BY md5('42|' || split_key), split_key) - 1 AS place,
         count(*) OVER () AS n
  FROM (SELECT DISTINCT split_key FROM keyed_pairs)),
sized AS (
  SELECT *, greatest(1, floor(n * CAST(0.8 AS DOUBLE))) AS n_train,
         CASE WHEN n > 2 THEN greatest(1, floor(n * CAST(0.1 AS DOUBLE))) ELSE 0 END AS n_val FROM ranked),
assigned AS (
  SELECT split_key, CASE WHEN place < n_train THEN 'train' WHEN place < n_train + n_val THEN 'val' ELSE 'test' END AS split
  FROM sized),
split_pairs AS (SELECT k.*, split FROM keyed_pairs k JOIN assigned USING (split_key))"""

# ---- preferences ------------------------------------------------------------
_REJECTED = (
    f"regexp_replace(output, '(?m)^({_WS}*)(assert property.*)$', '\\1// \\2  (disabled - checks nothing)', 'g')"
)
_PROMPT = "concat(instruction, chr(10), chr(10), 'Code:', chr(10), input)"
PREFERENCES = f"""prefs AS (
  SELECT {_PROMPT} AS prompt, output AS chosen, {_REJECTED} AS rejected
  FROM split_pairs WHERE split = 'train' AND task_type = 'sva_assertion_generation'
    AND contains(output, 'assert property') AND {_REJECTED} <> output)"""


def _sft(output: str) -> str:
    return (
        "concat('### Instruction:', chr(10), instruction, chr(10), chr(10), '### Input:', chr(10), input, "
        f"chr(10), chr(10), '### Response:', chr(10), {output})"
    )


# ---- scoring ----------------------------------------------------------------
SCORED = f"""joined AS (
  SELECT tag, item_id, task_type, instruction, input, reference, prediction, n_tokens_total, elapsed_s,
         row_number() OVER () AS id
  FROM predictions JOIN bench USING (item_id)),
toks AS MATERIALIZED (
  SELECT id, string_split({_strip(f"regexp_replace(prediction, '{_WS}+', ' ', 'g')")}, ' ') AS p,
         string_split({_strip(f"regexp_replace(reference, '{_WS}+', ' ', 'g')")}, ' ') AS r
  FROM joined WHERE reference <> ''),
ref_toks AS MATERIALIZED (SELECT id, unnest(r) AS token, generate_subscripts(r, 1) AS j FROM toks),
lcs AS (
  SELECT id, 0 AS i, j, token, 0 AS v FROM ref_toks
  UNION ALL
  SELECT id, i, j, token, max(best) OVER (PARTITION BY id ORDER BY j) AS v
  FROM (SELECT l.id, l.i + 1 AS i, l.j, l.token,
               greatest(l.v, CASE WHEN t.p[l.i + 1] = l.token
                 THEN 1 + coalesce(lag(l.v) OVER (PARTITION BY l.id ORDER BY l.j), 0) ELSE 0 END) AS best
        FROM lcs l JOIN toks t ON t.id = l.id WHERE l.i < len(t.p))),
common AS (SELECT toks.id, max(v) AS v, any_value(len(p)) AS np, any_value(len(r)) AS nr
           FROM toks JOIN lcs ON lcs.id = toks.id AND lcs.i = len(p) GROUP BY toks.id),
rouge AS (
  SELECT joined.*, CASE WHEN reference <> '' THEN CASE WHEN coalesce(v, 0) = 0 OR trim(prediction) = '' THEN 0.0
      ELSE 2 * (CAST(v AS DOUBLE) / np) * (CAST(v AS DOUBLE) / nr) / ((CAST(v AS DOUBLE) / np) + (CAST(v AS DOUBLE) / nr)) END END AS rouge_l
  FROM joined LEFT JOIN common USING (id)),
{_lint_table(f"SELECT {_first_code('prediction')} AS code FROM predictions")},
results AS (
  SELECT rouge.*, n_tokens_total / greatest(elapsed_s, 1e-6) AS tok_per_sec,
         CASE WHEN task_type IN ('sva_assertion_generation', 'rtl_bug_finding') THEN coalesce(ok, false) END AS compiles
  FROM rouge LEFT JOIN lint ON code_sha = sha256({_first_code('prediction')}))"""

# Keys that share a bucket, by the least key of the bucket, and what that reaches.
NEAR_SPLIT = SPLIT + """,
docs AS (SELECT pair_id AS doc_id, input || chr(10) || output AS content, split_key, split FROM split_pairs)"""
NEAR_GROUPS = """key_buckets AS (SELECT DISTINCT split_key, bucket FROM banded JOIN docs USING (doc_id)),
stars AS (SELECT DISTINCT split_key AS a, min(split_key) OVER (PARTITION BY bucket) AS b FROM key_buckets),
links AS (SELECT a, b FROM stars WHERE a <> b UNION SELECT b, a FROM stars WHERE a <> b),
reach AS (
  SELECT DISTINCT split_key, split_key AS other FROM docs
  UNION SELECT r.split_key, l.b FROM reach r JOIN links l ON l.a = r.other),
groups AS (SELECT split_key, min(other) AS split_group FROM reach GROUP BY 1),
ranked_groups AS (
  SELECT split_group, row_number() OVER (ORDER BY md5('42|' || split_group), split_group) - 1 AS place,
         count(*) OVER () AS n FROM (SELECT DISTINCT split_group FROM groups)),
near_assigned AS (
  SELECT split_key, split_group,
         CASE WHEN place < greatest(1, floor(n * CAST(0.8 AS DOUBLE))) THEN 'train'
              WHEN place < greatest(1, floor(n * CAST(0.8 AS DOUBLE)))
                + CASE WHEN n > 2 THEN greatest(1, floor(n * CAST(0.1 AS DOUBLE))) ELSE 0 END THEN 'val'
              ELSE 'test' END AS split
  FROM groups JOIN ranked_groups USING (split_group))"""

_RECORD_INPUTS = (FILES, RECORDS)
_DEDUPED = (DOCUMENTS, SIGNATURES, GREEDY)
_SCORING = (PREDICTIONS, BENCHMARK, SCORED)


def _inject(expr: str) -> str:
    return _query(*_RECORD_INPUTS, select=f"SELECT source_path, pos, {expr} AS edited FROM records WHERE type = 'sv_module'")


def statements() -> dict[str, str]:
    q = _query
    record_columns = "ext_rank, source_path, pos, type, module_name, title, content"
    return {
        # sources
        "scan_corpus": q(FILES, select=f"SELECT * REPLACE ({_SIZE_ON_DISK} AS n_bytes) FROM files"),
        "scan_report": q(FILES, select=f"""
            SELECT ext, count(*) + count(*) FILTER ({d.HAS_LOST_TWIN}) AS n_files,
                   CAST(sum({_SIZE_ON_DISK}) AS BIGINT) AS n_bytes,
                   count(*) FILTER ({d.HAS_BAD_BYTES}) AS n_invalid_text, count(*) FILTER ({d.HAS_LOST_TWIN}) AS n_skipped
            FROM files GROUP BY ext"""),
        "skipped_files": q(FILES, select=f"""
            SELECT path, 'too large' AS reason FROM files WHERE {_SIZE_ON_DISK} > {d.MAX_BYTES}
            UNION ALL SELECT path || '{d.LOST_END}', 'not found' FROM files WHERE {d.HAS_LOST_TWIN}"""),
        "read_records": q(DOCUMENTS, select="SELECT doc_id, content, source_path, type FROM docs"),
        "write_records": q(*_RECORD_INPUTS, select=f"SELECT {record_columns} FROM records"),
        "repo_sizes": q(FILES, select="""
            SELECT split_part(path, '/', 1) AS repository, count(*) AS n_files,
                   CAST(sum(strlen(content)) AS BIGINT) AS n_bytes FROM files GROUP BY 1"""),
        "provenance_gap": q(FILES, select="""
            SELECT split_part(path, '/', 1) AS repository, count(*) AS n_files,
                   CAST(sum(strlen(content)) AS BIGINT) AS n_bytes FROM files
            WHERE split_part(path, '/', 1) NOT IN (SELECT 'docs-' || source FROM documents) GROUP BY 1"""),
        "has_validation": q(PAIRS, SPLIT, select="""
            SELECT name AS split, count(split) > 0 AS present
            FROM (VALUES ('train'), ('val'), ('holdout')) n(name) LEFT JOIN split_pairs ON split = name GROUP BY name"""),
        # parsing
        "sv_modules": q(*_RECORD_INPUTS, select=f"SELECT {record_columns} FROM records WHERE type <> 'md_section'"),
        "sv_modules_masked": q(MASKED, select="""
            SELECT 0 AS ext_rank, path AS source_path, CAST(pos AS INTEGER) AS pos, type, module_name,
                   CAST(NULL AS VARCHAR) AS title, content FROM records"""),
        "md_sections": q(*_RECORD_INPUTS, select=f"SELECT {record_columns} FROM records WHERE type = 'md_section'"),
        "raw_records": q(*_RECORD_INPUTS, select=f"SELECT {record_columns} FROM records"),
        # near-duplicates
        "normalize_text": q(DOCUMENTS, select=f"SELECT doc_id, {_normalize('content')} AS normalized FROM docs"),
        "shingles": q(DOCUMENTS, f"""texts AS (SELECT doc_id, {_normalize('content')} AS t FROM docs),
            chars AS (SELECT doc_id, unnest(string_split(t, '')) AS c, generate_subscripts(string_split(t, ''), 1) AS p FROM texts),
            grams AS (SELECT DISTINCT doc_id, c || lead(c, 1) OVER w || lead(c, 2) OVER w || lead(c, 3) OVER w || lead(c, 4) OVER w AS s
                      FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY p) )""",
            select="""SELECT doc_id, count(*) AS n_shingles, min(s) AS first_shingle, max(s) AS last_shingle,
                   CAST(sum(('0x' || substr(md5(s), 1, 8))::BIGINT) AS BIGINT) AS checksum
            FROM grams WHERE s IS NOT NULL GROUP BY doc_id"""),
        "minhash": q(DOCUMENTS, SIGNATURES, select="SELECT doc_id, concat_ws(',', " + ", ".join(
            f"s{k}" for k in range(fv.NUM_PERM)) + ") AS signature FROM sigs"),
        "lsh_buckets": q(DOCUMENTS, SIGNATURES, select="SELECT doc_id, CAST(band AS INTEGER) AS band, bucket FROM banded"),
        "lsh_pairs": q(DOCUMENTS, SIGNATURES, select="""
            SELECT DISTINCT first, doc_id FROM (
              SELECT doc_id, min(doc_id) OVER (PARTITION BY bucket) AS first FROM banded) WHERE first < doc_id"""),
        "dedupe": q(*_DEDUPED, select="SELECT doc_id, content, source_path, type FROM kept"),
        "dedupe_stats": q(*_DEDUPED, select="""
            SELECT coalesce(d.type, 'all') AS type, count(*) AS n_in, count(k.doc_id) AS n_kept,
                   count(k.doc_id) / CAST(greatest(count(*), 1) AS DOUBLE) * 100 AS retained_pct
            FROM docs d LEFT JOIN kept k USING (doc_id) GROUP BY ROLLUP (d.type)"""),
        "dedupe_code": q(*_RECORD_INPUTS, NUMBERED.format(" WHERE type <> 'md_section'"), SIGNATURES, GREEDY,
            select=f"SELECT {record_columns} FROM kept"),
        "dedupe_chain": q(f"docs AS ({d.DRIFTING_RECORDS})", SIGNATURES, GREEDY,
            select="SELECT doc_id, content, source_path FROM kept"),
        "dedupe_batches": q(BATCHED, SIGNATURES, GREEDY, select="""
            SELECT own_id AS doc_id, batch, CAST(length(content) AS INTEGER) AS n_chars FROM kept"""),
        "dedupe_lookup": q(BATCHED, SIGNATURES, GREEDY, """near AS (
            SELECT b.doc_id, min(k.doc_id) AS first FROM banded b JOIN banded k USING (bucket)
            WHERE k.doc_id IN (SELECT doc_id FROM kept WHERE batch < 2) GROUP BY 1)""", select="""
            SELECT late.own_id AS doc_id, 'batch' || early.batch AS batch, early.own_id AS near_id
            FROM near JOIN docs late USING (doc_id) JOIN docs early ON early.doc_id = first WHERE late.batch = 2"""),
        "corpus_build": q(*_RECORD_INPUTS, NUMBERED.format(""), SIGNATURES, GREEDY,
            LABELED.replace("FROM records", "FROM kept"), select=f"""
            SELECT {record_columns}, domain, contains_assertion, contains_register_map, n_chars FROM labeled"""),
        "corpus_text_build": q(*_RECORD_INPUTS, NUMBERED.format(""), SIGNATURES, GREEDY, select=f"""
            SELECT row_number() OVER (ORDER BY ext_rank, source_path, pos) - 1 AS place, {_strip('content')} AS content
            FROM kept WHERE length({_strip('content')}) >= 30"""),
        "written_counts": q(*_RECORD_INPUTS, NUMBERED.format(""), SIGNATURES, GREEDY, LABELED, PAIRS, LINT, SPLIT,
            f"trimmed AS (SELECT length({_strip('content')}) AS n FROM records)", select="""
            SELECT 'parse' AS stage, type AS of, 'n_records' AS what, count(*) AS n FROM records GROUP BY ALL
            UNION ALL SELECT 'dedupe', coalesce(type, 'all'), 'n_in', count(*) FROM records GROUP BY ROLLUP (type)
            UNION ALL SELECT 'dedupe', coalesce(r.type, 'all'), 'n_kept', count(k.type)
              FROM docs r LEFT JOIN kept k USING (doc_id) GROUP BY ROLLUP (r.type)
            UNION ALL SELECT 'label', domain, 'n_records', count(*) FROM labeled GROUP BY ALL
            UNION ALL SELECT 'label', domain, 'n_with_assertion', count(*) FILTER (contains_assertion) FROM labeled GROUP BY ALL
            UNION ALL SELECT 'label', domain, 'n_with_register_map', count(*) FILTER (contains_register_map) FROM labeled GROUP BY ALL
            UNION ALL SELECT 'label', domain, 'sum_chars', CAST(sum(n_chars) AS BIGINT) FROM labeled GROUP BY ALL
            UNION ALL SELECT 'corpus', 'all', 'candidate_docs', count(*) FROM trimmed
            UNION ALL SELECT 'corpus', 'all', 'kept_docs', count(*) FROM trimmed WHERE n >= 30
            UNION ALL SELECT 'corpus', 'all', 'kept_chars', CAST(sum(n) AS BIGINT) FROM trimmed WHERE n >= 30
            UNION ALL SELECT 'lint', 'all', what, count(*) FROM linted JOIN (VALUES
              ('n_pairs', NULL), ('n_passed', 'verified_pass'), ('n_failed', 'verified_fail'), ('n_dropped', 'verified_fail'),
              ('n_skipped', 'not_applicable'), ('n_skipped', 'verilator_unavailable')) v(what, status)
              ON status IS NULL OR status = lint_status GROUP BY what
            UNION ALL SELECT 'split', split, 'n_rows', count(*) FROM split_pairs GROUP BY ALL"""),
        "kept_by_source": q(*_DEDUPED, select="""
            SELECT source_path, count(*) AS n_docs, CAST(sum(length(content)) AS BIGINT) AS n_chars
            FROM kept GROUP BY source_path"""),
        # labels and raw-text corpus
        "label_domain": q(*_RECORD_INPUTS, LABELED, select="SELECT source_path, pos, type, domain FROM labeled"),
        "label_flags": q(*_RECORD_INPUTS, LABELED, select="""
            SELECT source_path, pos, contains_assertion, contains_register_map, n_chars FROM labeled"""),
        "label_stats": q(*_RECORD_INPUTS, LABELED, select="""
            SELECT domain, count(*) AS n_records, count(*) FILTER (contains_assertion) AS n_with_assertion,
                   count(*) FILTER (contains_register_map) AS n_with_register_map,
                   CAST(sum(n_chars) AS BIGINT) AS sum_chars FROM labeled GROUP BY domain"""),
        "cpt_docs": q(DOCUMENTS, select=f"SELECT doc_id, {_strip('content')} AS content FROM docs WHERE length({_strip('content')}) >= 30"),
        "cpt_sink": q(DOCUMENTS, select=f"SELECT {_strip('content')} AS content FROM docs WHERE length({_strip('content')}) >= 30"),
        "cpt_sink_ordered": q(DOCUMENTS, select=f"""
            SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, {_strip('content')} AS content
            FROM docs WHERE length({_strip('content')}) >= 30"""),
        "cpt_reload": q(DOCUMENTS, select=f"SELECT {_strip('content')} AS content FROM docs WHERE length({_strip('content')}) > 30"),
        "cpt_stats": q(DOCUMENTS, f"t AS (SELECT length({_strip('content')}) AS n FROM docs)", select="""
            SELECT count(*) AS candidate_docs, count(*) FILTER (n >= 30) AS kept_docs,
                   CAST(coalesce(sum(n) FILTER (n >= 30), 0) AS BIGINT) AS kept_chars FROM t"""),
        "boundary_collisions": q(f"docs AS ({d.MARKED_RECORDS})", select=f"""
            SELECT count(*) FILTER (contains(content, '<|endofdoc|>')) AS n_docs_with_boundary
            FROM docs WHERE length({_strip('content')}) >= 30"""),
        # instruction pairs
        "inject_flip": _inject(_FLIP.format("content")),
        "inject_offby1": _inject(_OFF.format("content")),
        "inject_reset": _inject(_RESET.format("content")),
        "bug_pairs": q(*_RECORD_INPUTS, BUG_PAIRS, select="SELECT * FROM bugs"),
        "pairs_union": q(*_RECORD_INPUTS, BUG_PAIRS, CANDIDATES, COMPLETIONS, select=f"""
            SELECT * FROM bugs UNION ALL
            SELECT t, i, n, o, 'verified_hand_written_seed', NULL, NULL FROM (VALUES {_SEEDS}) seeds(t, i, n, o) UNION ALL
            SELECT *, NULL FROM generated"""),
        "gen_candidates": q(*_RECORD_INPUTS, CANDIDATES, select=f"""
            SELECT * FROM eligible ORDER BY md5(concat('42|', {_RECORD_KEY})), {_RECORD_KEY} LIMIT 100"""),
        "gen_prompts": q(*_RECORD_INPUTS, CANDIDATES, select="SELECT * FROM keyed"),
        "gen_ingest": q(*_RECORD_INPUTS, CANDIDATES, COMPLETIONS, select="SELECT * FROM generated"),
        "code_blocks": q(PAIRS, select=f"""
            SELECT pair_id, CAST(len(regexp_extract_all(output, '{_BLOCKS}', 1)) AS INTEGER) AS n_blocks,
                   array_to_string(regexp_extract_all(output, '{_BLOCKS}', 1), chr(1)) AS blocks,
                   {_first_code('output')} AS first_code FROM pairs_in"""),
        "lint_blocks": q(PAIRS, LINT, select="SELECT DISTINCT sha256(code) AS code_sha, code FROM blocks"),
        "lint_status": q(PAIRS, LINT, select="SELECT pair_id, task_type, lint_status FROM linted"),
        "lint_filter": q(PAIRS, LINT, select="SELECT pair_id, output, lint_status FROM linted WHERE lint_status <> 'verified_fail'"),
        "lint_stats": q(PAIRS, LINT, select="""
            SELECT count(*) AS n_pairs, count(*) FILTER (lint_status = 'verified_pass') AS n_passed,
                   count(*) FILTER (lint_status = 'verified_fail') AS n_failed,
                   count(*) FILTER (lint_status IN ('not_applicable', 'verilator_unavailable')) AS n_skipped,
                   count(*) FILTER (lint_status = 'verified_fail') AS n_dropped FROM linted"""),
        # split
        "split_keys": q(PAIRS, SPLIT, select="SELECT DISTINCT split_key, md5('42|' || split_key) AS draw FROM keyed_pairs"),
        "split_assign": q(PAIRS, SPLIT, select="SELECT split_key, split FROM assigned"),
        "split_rows": q(PAIRS, SPLIT, select="SELECT pair_id, task_type, split_key, split FROM split_pairs"),
        "split_stats": q(PAIRS, SPLIT, select="""
            SELECT name AS split, count(split) AS n_rows, count(split) = 0 AND name <> 'train' AS warn_empty
            FROM (VALUES ('train'), ('val'), ('test')) n(name) LEFT JOIN split_pairs ON split = name GROUP BY name"""),
        "split_leak_check": q(PAIRS, SPLIT, "per AS (SELECT split_key, count(DISTINCT split) AS k FROM split_pairs GROUP BY 1)",
            select="SELECT count(*) AS n_keys, count(*) FILTER (k > 1) AS n_leaking FROM per"),
        "near_split_assign": q(f"pairs_in AS ({d.DOCUMENT_PAIRS})", NEAR_SPLIT, SIGNATURES, NEAR_GROUPS,
            select="SELECT split_key, split_group, split FROM near_assigned"),
        "near_split_leak_check": q(f"pairs_in AS ({d.DOCUMENT_PAIRS})", NEAR_SPLIT, SIGNATURES, NEAR_GROUPS, """per AS (
            SELECT bucket, count(DISTINCT docs.split) AS s, count(DISTINCT n.split) AS g
            FROM banded JOIN docs USING (doc_id) JOIN near_assigned n USING (split_key) GROUP BY 1)""", select="""
            SELECT 'sources' AS kept_together, count(*) AS n_buckets, max(s) > 1 AS leaks FROM per
            UNION ALL SELECT 'near copies', count(*), max(g) > 1 FROM per"""),
        "tuning_build": q(*_RECORD_INPUTS, BUG_PAIRS, CANDIDATES, ANSWERS_WITH_CODE, f"""made AS (
            SELECT *, sha256(concat_ws(chr(1), task_type, instruction, input, output)) AS pair_id FROM (
              SELECT * FROM bugs UNION ALL
              SELECT t, i, n, o, 'verified_hand_written_seed', NULL, NULL FROM (VALUES {_SEEDS}) seeds(t, i, n, o)
              UNION ALL SELECT *, NULL FROM generated))""",
            LINT.replace("pairs_in", "made").replace(_VERIFY, f"{_VERIFY}, 'rtl_explanation'"),
            "pairs_in AS (SELECT * EXCLUDE (pair_id) FROM linted WHERE lint_status <> 'verified_fail')", SPLIT, select="""
            SELECT task_type, instruction, input, output, source, source_path, transform_applied, lint_status,
                   split_key, split FROM split_pairs"""),
        # preferences and training views
        "make_rejected": q(PAIRS, select=f"""
            SELECT pair_id, CASE WHEN contains(output, 'assert property') AND {_REJECTED} <> output
              THEN {_REJECTED} END AS rejected FROM pairs_in"""),
        "dpo_pairs": q(PAIRS, SPLIT, PREFERENCES, select="SELECT * FROM prefs"),
        "size_guards": q(PAIRS, SPLIT, PREFERENCES, select="""
            SELECT 'preference_pairs' AS dataset, count(*) AS n_rows,
                   CASE WHEN count(*) = 0 THEN 'warn_empty' WHEN count(*) < 4 THEN 'warn_few' ELSE 'ok' END AS verdict FROM prefs
            UNION ALL
            SELECT 'reward_prompts', count(*), CASE WHEN count(*) = 0 THEN 'stop_empty' ELSE 'ok' END
            FROM split_pairs WHERE split = 'train' AND task_type = 'sva_assertion_generation'"""),
        "sft_text": q(PAIRS, select=f"SELECT pair_id, {_sft('output')} AS text FROM pairs_in"),
        "rl_prompts": q(PAIRS, SPLIT, select=f"""
            SELECT pair_id, {_PROMPT} AS prompt FROM split_pairs
            WHERE split = 'train' AND task_type = 'sva_assertion_generation'"""),
        # scoring
        "eval_prompts": q(BENCHMARK, select="SELECT item_id, " + _sft("''") + " AS prompt FROM bench"),
        "eval_join": q(PREDICTIONS, BENCHMARK, select="""
            SELECT tag, item_id, task_type, reference, prediction FROM predictions JOIN bench USING (item_id)"""),
        "rouge_l": q(*_SCORING, select="SELECT tag, item_id, prediction, rouge_l FROM rouge"),
        "eval_compiles": q(*_SCORING, select="SELECT tag, item_id, task_type, prediction, compiles FROM results"),
        "eval_throughput": q(PREDICTIONS, select="""
            SELECT tag, item_id, n_tokens_total, elapsed_s, n_tokens_total / greatest(elapsed_s, 1e-6) AS tok_per_sec FROM predictions"""),
        "eval_results": q(*_SCORING, select="SELECT tag, task_type, prediction, tok_per_sec, rouge_l, compiles FROM results"),
        "eval_summary": q(*_SCORING, select="""
            SELECT tag, count(*) AS n_rows, round(sum(coalesce(rouge_l, 0)) / greatest(count(*), 1), 9) AS avg_rouge_l,
                   round(count(*) FILTER (compiles) / CAST(greatest(count(compiles), 1) AS DOUBLE), 9) AS compile_rate
            FROM results GROUP BY tag"""),
        "reward": q(PAIRS, _lint_table(f"SELECT {_first_code('output')} AS code FROM pairs_in"), select=f"""
            SELECT pair_id, CASE WHEN ok AND contains({_first_code('output')}, 'assert property') THEN 1.0::DOUBLE
                     WHEN ok THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END AS reward
            FROM pairs_in LEFT JOIN lint ON code_sha = sha256({_first_code('output')})"""),
    }
