"""The registered queries: one small function per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import fixed_values as fv
from corpusmill import schemas
from corpusmill.functions import minhash as sketch
from corpusmill.functions import text
from corpusmill.operators import dedupe as near
from corpusmill.operators import label, lint, pairs, parse, prefs, score, split
from corpusmill.operators.near_index import NearIndex
from corpusmill.plans import corpus, observed, scoring, tuning
from corpusmill.runtime import discard, materialize, scratch_path
from corpusmill.sources import corpus_text, files, jsonl, ordered_corpus, results, seeds
from corpusmill.workload import derived
from corpusmill.workload.corpus_folder import write_folder, write_folders

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _register(query: Query) -> Query:
    _QUERIES[query.__name__] = query
    return query


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return parse.raw_records(derived.files(spark, folder))


def _code_records(spark: SparkSession, folder: str) -> DataFrame:
    return parse.sv_modules(derived.code_files(spark, folder))


def _record_key():
    return F.concat_ws("#", "source_path", F.col("pos").cast("string"))


def _round_trip(records: DataFrame, label: str) -> str:
    path = scratch_path(records.sparkSession, label)
    jsonl.write_records(records, path)
    return path


# ---- sources and sinks ------------------------------------------------------
@_register
def scan_corpus(spark, folder):
    return files.scan_corpus(spark, write_folder(derived.files(spark, folder)))


@_register
def scan_report(spark, folder):
    return files.scan_report(spark, write_folder(derived.files(spark, folder)))


@_register
def skipped_files(spark, folder):
    """Links that lead nowhere, and files beyond a limit."""
    root = write_folder(derived.files(spark, folder))
    return files.skipped_files(spark, root, derived.MAX_BYTES).select("path", "reason")


@_register
def read_records(spark, folder):
    records = derived.document_records(spark, folder)
    return jsonl.read_records(spark, _round_trip(records, "records"), records.schema)


@_register
def write_records(spark, folder):
    path = _round_trip(_records(spark, folder), "raw-records")
    return jsonl.read_records(spark, path, schemas.RAW_RECORDS)


@_register
def repo_sizes(spark, folder):
    return files.repo_sizes(derived.files(spark, folder))


@_register
def provenance_gap(spark, folder):
    known = derived.select(
        spark, folder, "documents", "SELECT DISTINCT concat('docs-', source) AS repository FROM documents"
    )
    return files.provenance_gap(derived.files(spark, folder), known)


@_register
def has_validation(spark, folder):
    path = scratch_path(spark, "splits")
    rows = split.split_rows(derived.pairs(spark, folder))
    jsonl.write_records(rows, path, "split")
    found = [
        (name, jsonl.read_optional(spark, f"{path}/split={name}", schemas.PAIRS) is not None)
        for name in ("train", "val", "holdout")
    ]
    return spark.createDataFrame(found, "split string, present boolean")


# ---- parsing ----------------------------------------------------------------
@_register
def sv_modules(spark, folder):
    return parse.sv_modules(derived.files(spark, folder))


@_register
def sv_modules_masked(spark, folder):
    """Files full of words that would begin or end a module, were they not in comments and strings."""
    return parse.sv_modules(derived.forged_files(spark, folder), masked=True)


@_register
def md_sections(spark, folder):
    return parse.md_sections(derived.files(spark, folder))


@_register
def raw_records(spark, folder):
    return _records(spark, folder)


# ---- near-duplicates --------------------------------------------------------
@_register
def normalize_text(spark, folder):
    docs = derived.document_records(spark, folder)
    return docs.select("doc_id", text.normalize(F.col("content")).alias("normalized"))


@_register
def shingles(spark, folder):
    """Summed up row by row: a shingle is never a row, only the sums of rows with one id meet."""
    docs = derived.document_records(spark, folder).select("doc_id", sketch.shingles(F.col("content")).alias("s"))
    weight = lambda s: F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")
    told = F.struct(
        F.size("s").cast("bigint").alias("n"),
        F.array_min("s").alias("first"),
        F.array_max("s").alias("last"),
        F.aggregate("s", F.lit(0).cast("bigint"), lambda total, s: total + weight(s)).alias("checksum"),
    )
    # Through an array, so that no filter makes the shingles a second time.
    each = docs.select("doc_id", F.explode(F.array(told)).alias("told")).filter("told.n > 0")
    return each.groupBy("doc_id").agg(
        F.sum("told.n").alias("n_shingles"),
        F.min("told.first").alias("first_shingle"),
        F.max("told.last").alias("last_shingle"),
        F.sum("told.checksum").alias("checksum"),
    )


@_register
def minhash(spark, folder):
    signed = near.signatures(derived.document_records(spark, folder), ["doc_id"])
    return signed.select(
        "doc_id", F.concat_ws(",", F.col("sig").cast("array<string>")).alias("signature")
    )


@_register
def lsh_buckets(spark, folder):
    return near.lsh_buckets(near.signatures(derived.document_records(spark, folder), ["doc_id"]), ["doc_id"])


@_register
def lsh_pairs(spark, folder):
    return near.bucket_links(derived.document_records(spark, folder), "doc_id")


@_register
def dedupe(spark, folder):
    return near.dedupe(derived.document_records(spark, folder), ["doc_id"])


@_register
def dedupe_stats(spark, folder):
    docs = derived.document_records(spark, folder)
    return near.dedupe_stats(docs, near.dedupe(docs, ["doc_id"]))


@_register
def kept_by_source(spark, folder):
    return corpus.kept_by_source(derived.document_records(spark, folder), ["doc_id"])


@_register
def dedupe_code(spark, folder):
    """Code modules: a few templates, so very large groups of near-copies.

    The parsed records are written, as dedupe reads them twice.
    """
    return near.dedupe(materialize(_code_records(spark, folder), "records"), corpus.RECORD_ORDER)


@_register
def dedupe_chain(spark, folder):
    """Records that drift: long chains, each near the next only; what three rounds leave is walked."""
    return near.dedupe(derived.drifting_records(spark, folder), ["doc_id"], walk_rows=20_000)


def _inserted(spark, folder, batches) -> tuple[NearIndex, list[DataFrame]]:
    index = NearIndex(spark, scratch_path(spark, "near-index"))
    records = derived.batched_records(spark, folder)
    return index, [index.insert(records.filter(F.col("batch") == b), ["doc_id"], f"batch{b}") for b in batches]


@_register
def dedupe_batches(spark, folder):
    """Batch by batch into a new index."""
    index, kept = _inserted(spark, folder, range(3))
    index.close()
    return reduce(DataFrame.union, kept).select("doc_id", "batch", F.length("content").alias("n_chars"))


@_register
def dedupe_lookup(spark, folder):
    """The last batch looked up in an index of the others."""
    index, _ = _inserted(spark, folder, range(2))
    late = derived.batched_records(spark, folder).filter("batch = 2")
    found = materialize(index.lookup(late, ["doc_id"]), "lookup")
    index.close()
    return found.select("doc_id", "batch", F.col("key.doc_id").alias("near_id"))


# ---- labels and raw-text corpus ---------------------------------------------
@_register
def label_domain(spark, folder):
    return label.label_chunks(_records(spark, folder)).select("source_path", "pos", "type", "domain")


@_register
def label_flags(spark, folder):
    return label.label_chunks(_records(spark, folder)).select(
        "source_path", "pos", "contains_assertion", "contains_register_map", "n_chars"
    )


@_register
def label_stats(spark, folder):
    return label.label_stats(label.label_chunks(_records(spark, folder)))


@_register
def cpt_docs(spark, folder):
    docs = derived.document_records(spark, folder)
    return corpus_text.cpt_docs(docs.select("doc_id", "content"))


def _written_corpus(spark, folder) -> str:
    path = scratch_path(spark, "corpus-text")
    corpus_text.write_corpus(corpus_text.cpt_docs(derived.document_records(spark, folder)), path)
    return path


@_register
def cpt_sink(spark, folder):
    """The documents in the written files, cut only at the separator."""
    docs = spark.read.option("lineSep", corpus_text.DOC_SEPARATOR).text(_written_corpus(spark, folder))
    return docs.withColumnRenamed("value", "content")


@_register
def cpt_sink_ordered(spark, folder):
    """Documents and their places, as the shards hold them in the order of the manifest."""
    path = scratch_path(spark, "corpus-ordered")
    docs = corpus_text.cpt_docs(derived.document_records(spark, folder))
    ordered_corpus.write_ordered(docs, path, ["doc_id"], shard_bytes=1 << 20)
    return ordered_corpus.read_ordered(spark, path)


@_register
def cpt_reload(spark, folder):
    return corpus_text.read_corpus(spark, _written_corpus(spark, folder))


@_register
def cpt_stats(spark, folder):
    return corpus_text.cpt_stats(derived.document_records(spark, folder))


@_register
def boundary_collisions(spark, folder):
    return corpus_text.boundary_collisions(derived.marked_records(spark, folder))


# ---- instruction pairs ------------------------------------------------------
def _injected(spark, folder, edit: str) -> DataFrame:
    modules = _code_records(spark, folder).filter(F.col("type") == "sv_module")
    return modules.select("source_path", "pos", pairs.inject(F.col("content"), edit).alias("edited"))


@_register
def inject_flip(spark, folder):
    return _injected(spark, folder, "flip_comparison")


@_register
def inject_offby1(spark, folder):
    return _injected(spark, folder, "off_by_one_increment")


@_register
def inject_reset(spark, folder):
    return _injected(spark, folder, "invert_reset_polarity")


@_register
def bug_pairs(spark, folder):
    return pairs.bug_pairs(_code_records(spark, folder), _record_key())


@_register
def gen_candidates(spark, folder):
    candidates = pairs.gen_candidates(_code_records(spark, folder), _record_key())
    return candidates.select("source_path", "pos", "content")


@_register
def gen_prompts(spark, folder):
    modules = pairs.gen_eligible(_code_records(spark, folder)).select("source_path", "pos", "content")
    return pairs.gen_prompts(modules, _record_key())


def _completions(prompts: DataFrame) -> DataFrame:
    """Stand-in completions; every third prompt length failed, some were answered twice."""
    n = F.length("prompt")
    answered = prompts.filter(n % 3 > 0)
    answer = F.concat(F.lit("It is "), n.cast("string"), F.lit(" long.")).alias("completion")
    again = answered.filter(n % 5 == 0).select("prompt_key", F.lit("Another answer.").alias("completion"))
    return answered.select("prompt_key", answer).union(again)


@_register
def gen_ingest(spark, folder):
    prompts = gen_prompts(spark, folder)
    return pairs.gen_ingest(prompts, _completions(prompts))


@_register
def pairs_union(spark, folder):
    return pairs.pairs_union(
        bug_pairs(spark, folder), seeds.seed_pairs(spark), gen_ingest(spark, folder)
    )


@_register
def code_blocks(spark, folder):
    blocks = text.code_blocks(F.col("output"))
    return derived.pairs(spark, folder).select(
        "pair_id",
        F.size(blocks).alias("n_blocks"),
        F.concat_ws("\x01", blocks).alias("blocks"),
        text.first_code(F.col("output")).alias("first_code"),
    )


#: With assertions, whose answers are code as a whole if they hold no block.
_VERIFIED = (*fv.VERIFY_TASKS, fv.TASK_ASSERT)


def _linted(spark, folder) -> DataFrame:
    rows = derived.pairs(spark, folder)
    outcomes = derived.lint_results(lint.blocks_to_check(rows, _VERIFIED))
    return lint.lint_status(rows, outcomes, verify_tasks=_VERIFIED)


@_register
def lint_blocks(spark, folder):
    return lint.blocks_to_check(derived.pairs(spark, folder), _VERIFIED)


@_register
def lint_status(spark, folder):
    return _linted(spark, folder).select("pair_id", "task_type", "lint_status")


@_register
def lint_filter(spark, folder):
    return lint.lint_filter(_linted(spark, folder)).select("pair_id", "output", "lint_status")


@_register
def lint_stats(spark, folder):
    return lint.lint_stats(_linted(spark, folder))


# ---- split ------------------------------------------------------------------
@_register
def split_keys(spark, folder):
    return split.split_keys(derived.pairs(spark, folder))


@_register
def split_assign(spark, folder):
    return split.split_assign(split.split_keys(derived.pairs(spark, folder)))


@_register
def split_rows(spark, folder):
    rows = split.split_rows(derived.pairs(spark, folder))
    return rows.select("pair_id", "task_type", "split_key", "split")


@_register
def split_stats(spark, folder):
    return split.split_stats(split.split_rows(derived.pairs(spark, folder)))


@_register
def split_leak_check(spark, folder):
    return split.split_leak_check(split.split_rows(derived.pairs(spark, folder)))


@_register
def near_split_assign(spark, folder):
    return split.near_split_assign(derived.document_pairs(spark, folder))


@_register
def near_split_leak_check(spark, folder):
    """Near pairs in different splits: none when groups are kept together, some when sources only are."""
    pairs_in = split.with_bands(derived.document_pairs(spark, folder))
    checks = [
        split.near_leak_check(rows).select(F.lit(name).alias("kept_together"), "n_buckets", F.col("n_leaking") > 0)
        for name, rows in (("sources", split.split_rows(pairs_in)), ("near copies", split.near_split_rows(pairs_in)))
    ]
    return reduce(DataFrame.union, checks).toDF("kept_together", "n_buckets", "leaks")


# ---- preferences and training views -----------------------------------------
def _train(spark, folder) -> DataFrame:
    return split.split_rows(derived.pairs(spark, folder)).filter(F.col("split") == "train")


@_register
def make_rejected(spark, folder):
    return derived.pairs(spark, folder).select(
        "pair_id", prefs.make_rejected(F.col("output")).alias("rejected")
    )


@_register
def dpo_pairs(spark, folder):
    return prefs.dpo_pairs(_train(spark, folder))


@_register
def size_guards(spark, folder):
    train = _train(spark, folder)
    return prefs.size_guards(prefs.dpo_pairs(train), prefs.rl_prompts(train))


@_register
def sft_text(spark, folder):
    return prefs.sft_text(derived.pairs(spark, folder)).select("pair_id", "text")


@_register
def rl_prompts(spark, folder):
    return prefs.rl_prompts(_train(spark, folder)).select("pair_id", "prompt")


# ---- scoring ----------------------------------------------------------------
@_register
def eval_prompts(spark, folder):
    return score.eval_prompts(derived.benchmark(spark, folder)).select("item_id", "prompt")


def _joined(spark, folder) -> DataFrame:
    return score.eval_join(derived.benchmark(spark, folder), derived.predictions(spark, folder))


@_register
def eval_join(spark, folder):
    return _joined(spark, folder).select("tag", "item_id", "task_type", "reference", "prediction")


@_register
def rouge_l(spark, folder):
    return score.eval_rouge(_joined(spark, folder)).select("tag", "item_id", "prediction", "rouge_l")


def _prediction_lint(spark, folder) -> DataFrame:
    rows = derived.predictions(spark, folder)
    return derived.lint_results(rows.select(text.first_code(F.col("prediction")).alias("code")))


@_register
def eval_compiles(spark, folder):
    checked = score.eval_compiles(_joined(spark, folder), _prediction_lint(spark, folder))
    return checked.select("tag", "item_id", "task_type", "prediction", "compiles")


@_register
def eval_throughput(spark, folder):
    return score.eval_throughput(derived.predictions(spark, folder)).select(
        "tag", "item_id", "n_tokens_total", "elapsed_s", "tok_per_sec"
    )


def _results(spark, folder) -> DataFrame:
    return scoring.score_predictions(
        derived.benchmark(spark, folder),
        derived.predictions(spark, folder),
        _prediction_lint(spark, folder),
    )


@_register
def eval_results(spark, folder):
    """Tag by tag, the first one twice."""
    path, scored = scratch_path(spark, "results"), materialize(_results(spark, folder), "scored")
    tags = sorted(row[0] for row in scored.select("tag").distinct().collect())
    for tag in [*tags, *tags[:1]]:
        results.write_results(scored.filter(F.col("tag") == tag), path)
    return results.read_results(spark, path)


@_register
def eval_summary(spark, folder):
    summary = score.eval_summary(_results(spark, folder))
    return summary.select(
        "tag",
        "n_rows",
        F.round("avg_rouge_l", 9).alias("avg_rouge_l"),
        F.round("compile_rate", 9).alias("compile_rate"),
    )


@_register
def reward(spark, folder):
    rows = derived.pairs(spark, folder)
    outcomes = derived.lint_results(rows.select(text.first_code(F.col("output")).alias("code")))
    return score.reward(rows, outcomes, "output").select("pair_id", "reward")


# ---- summaries counted while tables are written ----
@_register
def written_counts(spark, folder):
    """The summaries of five stages over all records and pairs, one number a row.

    Records and labels are counted as they are written for the stages that read them.
    """
    order, tables = corpus.RECORD_ORDER, {}

    def keep(name: str) -> observed.Write:
        return lambda rows: tables.update({name: materialize(rows, name)})

    def away(rows: DataFrame) -> None:
        rows.write.format("noop").mode("overwrite").save()

    told = [
        ("parse", "type", observed.parse_counts(_records(spark, folder), keep("records"))),
        ("dedupe", "type", observed.dedupe_counts(tables["records"], order, away).drop("retained_pct")),
        ("label", "domain", observed.label_counts(tables["records"], keep("labeled"))),
        ("corpus", None, observed.corpus_counts(tables["labeled"], scratch_path(spark, "corpus"), order)),
        ("lint", None, observed.lint_counts(_linted(spark, folder), away)),
        ("split", "split", observed.split_counts(split.split_rows(derived.pairs(spark, folder)), away).drop("warn_empty")),
    ]
    rows = [
        (stage, row[group] if group else "all", name, row[name])
        for stage, group, summary in told for row in summary.collect() for name in summary.columns if name != group
    ]
    return spark.createDataFrame(rows, "stage string, of string, what string, n bigint")


# ---- whole flows ------------------------------------------------------------
@_register
def corpus_build(spark, folder):
    """Files to labelled, deduplicated chunks."""
    return corpus.build_chunks(derived.files(spark, folder))


@_register
def corpus_text_build(spark, folder):
    """Folders of files to the raw-text corpus, read again in its order.

    Small files take whole blocks of disk, so the folders have bounded bytes and
    each is cleared once its records are written. What is done with goes at once.
    """
    path = scratch_path(spark, "corpus-text")
    discard(corpus.build_corpus(spark, write_folders(derived.files(spark, folder)), path))
    return ordered_corpus.read_ordered(spark, path)


def _answers_with_code(prompts: DataFrame) -> DataFrame:
    """Stand-in completions: every third prompt length failed, every second answer holds a block."""
    n = F.length("prompt")
    block = F.concat(F.lit("\n```systemverilog\nwire w"), F.repeat(F.lit("x"), n % 6), F.lit(";\n```"))
    answer = F.concat(F.lit("It is "), n.cast("string"), F.lit(" long."), F.when(n % 2 == 0, block).otherwise(""))
    return prompts.filter(n % 3 > 0).select("prompt_key", answer.alias("completion"))


@_register
def tuning_build(spark, folder):
    """Chunks to split pairs: edits, seeds and completions, linted, failed ones dropped."""
    chunks = label.label_chunks(_records(spark, folder))
    prompts = pairs.gen_prompts(pairs.gen_eligible(chunks), _record_key())
    generated = materialize(pairs.gen_ingest(prompts, _answers_with_code(prompts)), "generated")
    verified, seeded = (*_VERIFIED, fv.TASK_EXPLAIN), seeds.seed_pairs(spark)
    answers = pairs.pairs_union(generated, seeded).withColumn("pair_id", pairs.pair_key())
    outcomes = derived.lint_results(lint.blocks_to_check(answers, verified))
    return tuning.build_pairs(chunks, _record_key(), seeded, generated, outcomes, verified)
