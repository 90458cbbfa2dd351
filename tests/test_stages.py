"""The stage commands, from a folder of files to scored predictions."""

import pytest
from pyspark.sql import functions as F

from corpusmill import __main__, schemas
from corpusmill.operators import lint
from corpusmill.operators.score import eval_summary
from corpusmill.plans import stages
from corpusmill.sources import jsonl
from corpusmill.sources.results import read_results

MODULE = "module {0} (input clk);\n  always @(posedge clk) if (count_{0} == {1}) state_{0} <= {1};\n  // {2}\nendmodule\n"


@pytest.fixture
def data(tmp_path):
    raw = tmp_path / "raw"
    for i in range(30):
        repo = raw / f"repo{i % 3}"
        repo.mkdir(parents=True, exist_ok=True)
        filler = " ".join(f"w{i * 100 + k}" for k in range(40))
        (repo / f"m{i}.sv").write_text(MODULE.format(f"m{i}", i, filler) * (1 + i % 2))
    (raw / "repo0" / "copy.sv").write_text((raw / "repo0" / "m0.sv").read_text())
    (raw / "repo1" / "notes.md").write_text("intro\n# Title\n" + "Some words on the register map. " * 5)
    return tmp_path


def test_all_stages(spark, data, capsys):
    def path(name):
        return str(data / name)

    def stage(*arguments):
        __main__.main(list(arguments))
        return capsys.readouterr().out

    stage("parse", path("raw"), path("records"))
    assert jsonl.read_records(spark, path("records"), schemas.RAW_RECORDS).count() == 15 + 30 + 1 + 2
    assert "retained_pct" in stage("dedupe", path("records"), path("chunks"))
    kept = jsonl.read_records(spark, path("chunks"), schemas.RAW_RECORDS)
    # The 15 repeats within a file and one of the two equal files go, and the short intro.
    assert kept.filter("type = 'sv_module'").count() == 30 and kept.count() == 31
    for batch, n in (("one", 31), ("two", 0), ("one", 31)):
        stage("dedupe", path("records"), path(batch), "--index", path("index"), "--batch", batch)
        assert jsonl.read_records(spark, path(batch), schemas.RAW_RECORDS).count() == n
    stage("label", path("chunks"), path("labeled"))
    assert "kept_chars" in stage("corpus", path("labeled"), path("text"))
    stage("prompts", path("labeled"), path("prompts"), "--n", "5")

    asked = jsonl.read_records(spark, path("prompts"), stages.PROMPTS)
    assert asked.count() == 5
    answers = asked.limit(3).select("prompt_key", F.lit("It counts.").alias("completion"))
    jsonl.write_records(answers, path("answers"))
    stage("pairs", path("labeled"), path("pairs"), "--prompt-table", path("prompts"), "--completions", path("answers"))
    made = jsonl.read_records(spark, path("pairs"), schemas.PAIRS)
    counts = {r["source"]: r["count"] for r in made.groupBy("source").count().collect()}
    assert counts == {"mechanical_bug_injection": 30, "verified_hand_written_seed": 3, "llm_augmented": 3}
    assert "|0" in stage("blocks", path("pairs"), path("blocks"))

    stage("split", path("pairs"), path("split"))
    rows = jsonl.read_records(spark, path("split"), stages.SPLIT_PAIRS)
    assert rows.count() == 36 and rows.groupBy("split_key").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    assert "preference_pairs" in stage("preferences", path("split"), path("prefs"))
    # The one assertion pair is a seed; whether it is in the train split is the draw's.
    in_train = rows.filter("split = 'train' and task_type = 'sva_assertion_generation'").count()
    if in_train:
        assert f"|{in_train} " in stage("reward-prompts", path("split"), path("rewards"))
    jsonl.write_records(rows.filter("task_type <> 'sva_assertion_generation'"), path("bare"), "split")
    with pytest.raises(ValueError, match="nothing to train on"):
        stage("reward-prompts", path("bare"), path("none"))
    assert not (data / "none").exists()

    items = [(1, "rtl_explanation", "Explain.", "x", "it counts up"), (2, "rtl_bug_finding", "Find.", "y", None)]
    jsonl.write_records(spark.createDataFrame(items, schemas.BENCHMARK), path("bench"))
    answers = [("base", 1, "it counts down", 10, 2.0), ("base", 2, "bad code", 10, 0.0), ("tuned", 1, "it counts up", 9, 1.0)]
    jsonl.write_records(spark.createDataFrame(answers, schemas.PREDICTIONS), path("answers2"))
    checked = spark.createDataFrame([("bad code", True)], "code string, ok boolean")
    jsonl.write_records(checked.select(lint.code_sha(F.col("code")).alias("code_sha"), "ok"), path("lint"))
    stage("evaluate", path("bench"), path("answers2"), path("scores"), "--lint-results", path("lint"))
    got = {r["tag"]: tuple(r)[1:] for r in eval_summary(read_results(spark, path("scores"))).collect()}
    assert got["base"] == (2, pytest.approx(1 / 3), 1.0) and got["tuned"] == (1, 1.0, 0.0)
