"""Instruction pairs: mechanical edits of real modules, seeds and completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill import fixed_values as fv
from corpusmill.functions.text import content_sha, replace_first


def inject(text: Column, edit: str) -> Column:
    """Apply one named edit at its first match; text without a match is unchanged."""
    spec = fv.BUG_EDITS[edit]
    return replace_first(text, spec["pattern"], spec["replacement"])


def _by_edit(choice: Column, value) -> Column:
    out = F.lit(None).cast("string")
    for name in fv.BUG_EDITS:
        out = F.when(choice == name, value(name)).otherwise(out)
    return out


def choose_edit(text: Column, key: Column, seed: int = fv.SEED) -> Column:
    """One applicable edit per record, uniformly by a seeded hash of its key; else null.

    The choice depends on the record alone, so it is the same for every
    partitioning and needs no shared random state.
    """
    draws = [
        F.when(
            text.rlike(spec["pattern"]),
            F.concat(F.md5(F.concat_ws("|", F.lit(str(seed)), key, F.lit(name))), F.lit(name)),
        )
        for name, spec in fv.BUG_EDITS.items()
    ]
    return F.substring(F.least(*draws), 33, 64)


def bug_pairs(chunks: DataFrame, key: Column, seed: int = fv.SEED) -> DataFrame:
    """Bug-finding pairs from modules of 40 to 3000 characters with an applicable edit."""
    text = F.col("content")
    eligible = chunks.filter(F.col("type") == fv.TYPE_MODULE).filter(
        F.length(text).between(fv.BUG_MIN_CHARS, fv.BUG_MAX_CHARS)
    )
    # A null stays away through the generator, which no filter is pushed below.
    drawn = F.array_compact(F.array(choose_edit(text, key, seed)))
    chosen = eligible.select("content", "source_path", F.explode(drawn).alias("transform_applied"))
    edit = F.col("transform_applied")
    return chosen.select(
        F.lit(fv.TASK_BUG).alias("task_type"),
        F.lit(fv.BUG_INSTRUCTION).alias("instruction"),
        _by_edit(edit, lambda name: inject(text, name)).alias("input"),
        F.concat(
            F.lit(fv.BUG_ANSWER_HEAD),
            _by_edit(edit, lambda name: F.lit(fv.BUG_EDITS[name]["desc"])),
            F.lit(fv.BUG_ANSWER_TAIL),
        ).alias("output"),
        F.lit(fv.SOURCE_MECHANICAL).alias("source"),
        "source_path",
        "transform_applied",
    )


def pairs_union(*parts: DataFrame) -> DataFrame:
    """All pairs in one table; a column a part lacks is null."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def gen_eligible(chunks: DataFrame) -> DataFrame:
    """Modules between 100 and 2000 characters, which a model can explain."""
    size = F.length("content")
    modules = chunks.filter(F.col("type") == fv.TYPE_MODULE)
    return modules.filter((size > fv.GEN_MIN_CHARS) & (size < fv.GEN_MAX_CHARS))


def gen_candidates(
    chunks: DataFrame, key: Column, n: int = fv.GEN_DEFAULT_ROWS, seed: int = fv.SEED
) -> DataFrame:
    """`n` eligible modules in a seeded hash order.

    Spark keeps a top-n per task and merges those, so this never sorts the table.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), key))
    return gen_eligible(chunks).withColumn("draw", draw).orderBy("draw", key).limit(n).drop("draw")


def gen_prompts(modules: DataFrame, key: Column) -> DataFrame:
    """Add the prompt to send and `prompt_key`, which a completion refers to.

    `key` names a module: equal modules of one file have prompts of their own.
    """
    prompt = F.concat(
        F.lit(fv.EXPLAIN_PROMPT_HEAD), F.col("content"), F.lit(fv.EXPLAIN_PROMPT_TAIL)
    )
    return modules.withColumn("prompt", prompt).withColumn("prompt_key", content_sha(key, prompt))


def gen_ingest(
    prompts: DataFrame, completions: DataFrame, source: str = fv.SOURCE_GENERATED
) -> DataFrame:
    """Explanation pairs for prompts with a completion; a failed call has none.

    Of several completions of one prompt the least text counts.

    Both sides hold texts, whose size Spark does not know before they are made: a
    few kilobytes of keys can become gigabytes, so neither side is broadcast.
    """
    single = completions.groupBy("prompt_key").agg(F.min("completion").alias("completion"))
    return prompts.join(single.hint("merge"), "prompt_key").select(
        F.lit(fv.TASK_EXPLAIN).alias("task_type"),
        F.lit(fv.EXPLAIN_INSTRUCTION).alias("instruction"),
        F.col("content").alias("input"),
        F.col("completion").alias("output"),
        F.lit(source).alias("source"),
        "source_path",
    )


def pair_key() -> Column:
    """A stable name for a pair: the hash of its content."""
    return content_sha(
        *[F.coalesce(c, F.lit("")) for c in ("task_type", "instruction", "input", "output")]
    )
