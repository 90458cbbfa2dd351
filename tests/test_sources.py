"""Readers and writers on real files."""

import os

import pytest
from pyspark.sql import functions as F

from corpusmill import runtime, schemas
from corpusmill.plans import corpus
from corpusmill.sources import corpus_text, files, jsonl, results, tables
from corpusmill.sources.seeds import seed_pairs


@pytest.fixture
def tree(tmp_path):
    def put(name, data: bytes):
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)

    put("r1/a b.sv", b"module a;\r\nendmodule\rx")
    put("r1/deep/er/c.SV", b"no: extension case differs")
    put("r2/bad.v", b"ok\xff\xfe \xe2\x28\xa1 \xef\xbf\xbd end")
    put("r2/n.md", "# Tïtle".encode())
    put("r2/n.txt", b"no")
    put("r2/x.svh", b"")
    put(".github/b.md", b"hidden")
    put("_docs/deep/c.md", b"# underscore")
    put("r1/_d.md", b"private")
    put("r3/clash.v", "\ufdd0a\ufffd\ufdd1\ufdd2".encode() + b"\xff" + "\ufdd01".encode())
    return str(tmp_path / "raw")


def test_scan(spark, tree):
    got = {r["path"]: (r["ext"], r["ext_rank"], r["content"]) for r in files.scan_corpus(spark, tree).collect()}
    bad = b"ok\xff\xfe \xe2\x28\xa1 \xef\xbf\xbd end".decode(errors="ignore")
    assert got == {
        "r1/a b.sv": ("sv", 0, "module a;\nendmodule\nx"),
        "r2/bad.v": ("v", 1, bad),
        "r2/n.md": ("md", 3, "# Tïtle"),
        "r2/x.svh": ("svh", 2, ""),
        ".github/b.md": ("md", 3, "hidden"),
        "_docs/deep/c.md": ("md", 3, "# underscore"),
        "r1/_d.md": ("md", 3, "private"),
        "r3/clash.v": ("v", 1, "\ufdd0a\ufffd\ufdd1\ufdd2\ufdd01"),
    }
    assert files.scan_corpus(spark, "file://" + tree).count() == 8  # a scheme is fine too


def test_roots_are_cut_exactly(spark, tree, monkeypatch):
    """Relative roots, and a root whose text occurs again further down."""
    top = os.path.dirname(tree)
    again = os.path.join(tree, "raw", "raw")
    os.makedirs(again)
    with open(os.path.join(again, "a.md"), "w") as file:
        file.write("x")
    monkeypatch.chdir(top)
    for root in ("raw", "./raw/", f"../{os.path.basename(top)}/raw", tree):
        paths = {r["path"] for r in files.scan_corpus(spark, root).select("path").collect()}
        assert {"raw/raw/a.md", "r2/n.md"} <= paths and len(paths) == 9
    monkeypatch.chdir(tree)
    assert files.scan_corpus(spark, ".").filter("path = 'r2/n.md'").count() == 1


def test_what_cannot_be_read_is_told(spark, tree):
    os.symlink("/nowhere/at/all.md", os.path.join(tree, "r1", "lost.md"))
    listing = files.found_files(files.list_files(spark, tree))
    gone = listing.filter("path = 'r2/n.md'").withColumn("path", F.lit("r2/gone.md"))
    read = files.read_files(spark, tree, listing.union(gone)).filter("error is not null")
    assert "r2/gone.md" in {r["path"] for r in read.collect()}
    told = {r["path"]: r["reason"] for r in files.skipped_files(spark, tree, max_bytes=20).collect()}
    assert told == {"r1/lost.md": "not found", "r1/a b.sv": "too large"}
    assert files.scan_corpus(spark, tree).filter("path = 'r1/lost.md'").isEmpty()
    missing = files.skipped_files(spark, tree + "/none").collect()
    assert [(r["path"], r["reason"]) for r in missing] == [("", "not found")] and missing[0]["error"]


def test_links_to_folders_are_not_followed(spark, tree):
    os.symlink(tree, os.path.join(tree, "r1", "round.md"))
    assert files.list_files(spark, tree).filter("path like '%round%'").isEmpty()


def test_a_flat_folder_is_read_by_many_tasks(spark, tmp_path):
    """One folder holds nearly all bytes, one file a third of them."""
    for i in range(60):
        (tmp_path / f"f{i:02d}.md").write_bytes(b"x" * (600_000 if i == 7 else 20_000))
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.sv").write_bytes(b"module")
    listed = files.found_files(files.list_files(spark, str(tmp_path)))
    read = files.read_files(spark, str(tmp_path), listed, split_bytes=300_000)
    parts = read.select(F.spark_partition_id().alias("part"), "path", F.octet_length("data").alias("n"))
    rows = parts.collect()
    assert sorted(r["path"] for r in rows) == sorted(["deep/a.sv", *[f"f{i:02d}.md" for i in range(60)]])
    by_part = {}
    for r in rows:
        by_part.setdefault(r["part"], []).append(r["n"])
    assert len(by_part) >= 12 and all(sum(own) - max(own) <= 300_000 for own in by_part.values())


def test_pieces_of_a_listing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PIECE_ROWS", 7)
    for i in range(40):
        (tmp_path / f"{i}.md").write_text("x")
    assert files.list_files(spark, str(tmp_path)).count() == 40
    assert files.scan_corpus(spark, str(tmp_path)).count() == 40
    empty = tmp_path / "empty"
    empty.mkdir()
    assert files.scan_corpus(spark, str(empty)).count() == 0


def test_scan_report_and_repositories(spark, tree):
    report = {r["ext"]: r["n_invalid_text"] for r in files.scan_report(spark, tree).collect()}
    assert report == {"sv": 0, "v": 2, "md": 0, "svh": 0}
    scanned = files.scan_corpus(spark, tree)
    sizes = {r["repository"]: r["n_files"] for r in files.repo_sizes(scanned).collect()}
    assert sizes == {"r1": 2, "r2": 3, "r3": 1, ".github": 1, "_docs": 1}
    listed = files.found_files(files.list_files(spark, tree))
    assert sorted(files.repo_sizes(listed).collect()) == sorted(files.repo_sizes(scanned).collect())
    known = spark.createDataFrame([("r1", "u", "l")], schemas.SOURCES)
    assert [r["repository"] for r in files.provenance_gap(scanned, known).orderBy("repository").collect()] == [".github", "_docs", "r2", "r3"]


def test_jsonl_keeps_nulls_and_fills_missing_fields(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", None), ("é\n", 1)], "s string, n bigint")
    jsonl.write_records(rows.coalesce(1), path)
    lines = [line for f in (tmp_path / "t").glob("*.json") for line in f.read_text().splitlines()]
    assert '{"s":"a","n":null}' in lines
    wider = rows.select("s", "n", F.lit(None).cast("string").alias("extra"))
    assert sorted(map(str, jsonl.read_records(spark, path, wider.schema).collect())) == sorted(
        map(str, wider.collect())
    )
    jsonl.write_records(rows.limit(0), path)
    assert jsonl.read_records(spark, path, rows.schema).count() == 0
    assert jsonl.read_optional(spark, path, rows.schema) is None
    assert jsonl.read_optional(spark, path + "-none", rows.schema) is None


def test_raw_text_limits(spark, tmp_path):
    path = str(tmp_path / "cpt")
    docs = ["x" * n for n in (29, 30, 31)] + ["  line one\nline two of a document \n" + "y" * 20]
    chunks = spark.createDataFrame([(d,) for d in docs], "content string")
    corpus_text.write_corpus(corpus_text.cpt_docs(chunks).coalesce(1), path)
    text = "".join(f.read_text() for f in (tmp_path / "cpt").glob("part-*"))
    assert text.count("\n<|endofdoc|>\n") == 3 and text.startswith("x" * 30 + "\n<|endofdoc|>\n")
    got = sorted(r["content"] for r in corpus_text.read_corpus(spark, path).collect())
    assert got == sorted(["x" * 31, docs[3].strip()])
    stats = corpus_text.cpt_stats(chunks).first()
    assert tuple(stats) == (4, 3, 30 + 31 + len(docs[3].strip()))


def test_boundary_inside_a_document(spark):
    chunks = spark.createDataFrame([("a" * 40 + "<|endofdoc|>",), ("b" * 40,)], "content string")
    assert corpus_text.boundary_collisions(chunks).first()[0] == 1


def test_results_per_tag(spark, tmp_path):
    path = str(tmp_path / "res")
    rows = [("t", "p", 1.0, None, None, "base"), ("t", "q", 2.0, 0.5, True, "tuned")]
    table = spark.createDataFrame(rows, schemas.RESULTS)
    results.write_results(table, path)
    back = results.read_results(spark, path)
    assert back.columns == schemas.RESULTS.fieldNames()
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))
    assert back.filter("tag = 'sft'").count() == 0
    # A further tag leaves the others, a repeated one is replaced.
    results.write_results(spark.createDataFrame([("t", "r", 1.0, None, None, "sft")], schemas.RESULTS), path)
    results.write_results(spark.createDataFrame([("t", "z", 1.0, None, None, "base")], schemas.RESULTS), path)
    told = sorted((r["tag"], r["prediction"]) for r in results.read_results(spark, path).collect())
    assert told == [("base", "z"), ("sft", "r"), ("tuned", "q")]


def test_a_broken_line_stops_the_read(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"s":"x"}\nnot json\n')
    schema = spark.createDataFrame([], "s string").schema
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        jsonl.read_records(spark, str(tmp_path), schema).collect()


def test_seeds(spark):
    assert seed_pairs(spark).select("task_type").distinct().count() == 3


def test_whole_flow_from_files(spark, tree, tmp_path):
    chunks = corpus.build_corpus(spark, tree, str(tmp_path / "out"))
    assert chunks.columns == schemas.CHUNKS_LABELED.fieldNames()


def test_scratch_folder_is_the_configured_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    table = runtime.materialize(spark.range(3), "x")
    assert table.count() == 3 and all(f"{shared}/x-" in name for name in table.inputFiles())


def test_small_scans_are_spread_and_large_ones_left_alone(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "small.parquet"))
    spark.range(100).repartition(20).write.parquet(str(tmp_path / "large.parquet"))
    small = tables.load_table(spark, str(tmp_path), "small")
    large = tables.load_table(spark, str(tmp_path), "large")
    assert tables.spread(small, "id").rdd.getNumPartitions() == 8
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        large = tables.load_table(spark, str(tmp_path), "large")
        assert "Exchange" not in tables.spread(large, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
