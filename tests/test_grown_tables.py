"""Steps whose cost must not grow faster than the tables."""

import hashlib
import os
import pathlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import sketch
from corpusmill.operators import dedupe
from corpusmill.plans import corpus
from corpusmill.sources import corpus_text, ordered_corpus
from corpusmill.workload import corpus_folder, derived, registry

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, tmp_path, rows):
    table = spark.createDataFrame([(i, text, "en", "web", len(text or "")) for i, text in rows], DOCUMENTS)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def weight(*each):
    return sum(int(hashlib.md5(s.encode()).hexdigest()[:8], 16) for s in each)


def test_a_shingle_is_never_a_row(spark, tmp_path):
    rows = [(1, "abcdef"), (1, "abcdez"), (None, "Abcde"), (2, "abc"), (3, None), (4, "aaaaaaaa")]
    found = registry.queries()["shingles"](spark, documents(spark, tmp_path, rows))
    assert "explode(array_distinct" not in found._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in found.collect()} == {
        (1, 4, "abcde", "bcdez", weight("abcde", "bcdef", "abcde", "bcdez")),
        (None, 1, "abcde", "abcde", weight("abcde")),
        (4, 1, "aaaaa", "aaaaa", weight("aaaaa")),
    }


def test_a_filter_on_types_parses_no_file_in_the_scan(spark):
    made = registry.queries()["gen_prompts"](spark, "/root/testdata/sf0.001")
    scan = made._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert "size(" not in scan and "regexp_extract_all" not in scan


def test_drifting_texts_are_made_above_the_scan(spark):
    kept = dedupe.long_enough(derived.drifting_records(spark, "/root/testdata/sf0.001"))
    optimized = kept._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in optimized.splitlines() if "Filter" in line and "md5" in line]


def test_signatures_of_a_batch_with_nulls():
    texts = pa.array(["abcdefgh" * 20, None, "", "abcd", "x" * 99])
    (made,) = sketch.signatures(iter([texts[1:]]))
    want = [None if t is None else sketch.minima(sketch.shingle_hashes(t)).tolist() for t in texts[1:].to_pylist()]
    assert made.to_pylist() == want and made.type == pa.list_(pa.int32())


@pytest.mark.parametrize("n", [0, 4, 5, 6, 1000])
def test_shingle_hashes_follow_the_rule(n):
    text = "".join(chr(97 + i * i % 23) for i in range(n))
    want = []
    for i in range(max(0, n - 4)):
        x = 0
        for c in text[i : i + 5]:
            x = ((x ^ ord(c)) * sketch.MIX) % 2**32
            x ^= x >> 15
        want.append(x)
    assert np.array_equal(sketch.shingle_hashes(text), np.array(want, dtype=np.uint32))


def test_texts_are_hashed_in_groups(monkeypatch):
    """One pass over the characters of many texts; none sees the shingles of the next."""
    texts = ["abcdefgh" * 20, "abcd", None, "", "İß é x" * 9, "𝒳𝒴 z𝒳 abc", "long " * 500, "x" * 99]
    want = [None if t is None else sketch.minima(sketch.shingle_hashes(sketch.normalized(t))).tolist() for t in texts]
    hashed, hashes_of = [], sketch.shingle_hashes
    monkeypatch.setattr(sketch, "GROUP_CHARS", 1000)
    monkeypatch.setattr(sketch, "shingle_hashes", lambda text: hashed.append(text) or hashes_of(text))
    (made,) = sketch.signatures(iter([pa.array(texts)]))
    assert made.to_pylist() == want and len(hashed) == 3


def in_chains(sizes):
    """(bucket, salt, salts, __ord) of chains of records, each in a bucket with the next."""
    rows, at = [], 0
    for size in sizes:
        for i in range(at, at + size - 1):
            rows += [(f"{i}", 0, 1, i), (f"{i}", 0, 1, i + 1)]
        at += size
    return rows


def test_rounds_go_on_while_they_leave_less_than_half(spark, monkeypatch):
    """Then no component is looked for, however many records are undecided after the first rounds."""
    sizes = [2] * 64 + [4] * 32 + [6] * 16 + [8] * 8 + [10] * 4 + [12] * 2 + [14]
    monkeypatch.setattr(dedupe, "components", lambda links: pytest.fail("walked"))
    shared = spark.createDataFrame(in_chains(sizes), "bucket string, salt int, salts int, __ord bigint")
    removed = [row[0] for each in dedupe._removed_in_rounds(shared, walk_rows=1) for row in each.collect()]
    starts = np.cumsum([0, *sizes[:-1]])
    assert sorted(removed) == sorted(int(s) + i for s, size in zip(starts, sizes) for i in range(1, size, 2))


def test_a_code_that_was_checked_twice_is_read_once(spark):
    codes = spark.createDataFrame([("a" * n,) for n in (*range(60), 11)] + [(None,)], "code string")
    found = derived.lint_results(codes)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    verdict = lambda n: None if n % 5 == 0 else n % 5 != 1
    sha = {n: hashlib.sha256(b"a" * n).hexdigest() for n in range(60) if n % 7 != 3}
    want = {(s, ok) for n, s in sha.items() for ok in ([verdict(n), False] if n % 11 == 0 else [verdict(n)])}
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_dedupe_code_parses_its_files_once(spark, tmp_path):
    """Its result reads written records, and no file is parsed again."""
    part = [(i, f"almond {i}", "7", 3) for i in range(1, 30)]
    spark.createDataFrame(part, "p_partkey bigint, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    found = registry.queries()["dedupe_code"](spark, str(tmp_path))
    assert "regexp_extract_all" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() > 0


def test_written_counts_labels_its_records_once(spark, tmp_path, monkeypatch):
    """Labels are counted in the pass that writes them for the corpus; no other pass makes them."""
    part = [(i, f"almond {i}", "7", 3) for i in range(1, 30)]
    spark.createDataFrame(part, "p_partkey bigint, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(registry.label, "label_chunks", lambda rows: pytest.fail("labelled a second time"))
    told = registry.queries()["written_counts"](spark, documents(spark, tmp_path, [(1, "a text " * 20), (2, None)])).collect()
    n = {(row.stage, row.what): 0 for row in told}
    for row in told:
        n[row.stage, row.what] += row.n
    assert n["parse", "n_records"] == n["label", "n_records"] == n["corpus", "candidate_docs"] > 29


def scratch(spark):
    """What lies in the shared folder, names without their numbers."""
    found = os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    return Counter(name.rsplit("-", 1)[0] for name in found)


def test_folders_have_bounded_bytes_and_go_one_after_the_other(spark, monkeypatch):
    texts = {f"r{i % 3}/d{i}{'.md' if i % 2 else '.sv'}": f"text {i} " * (i * 40) for i in range(60)}
    rows = [*texts.items(), ("r0/d3.md", texts["r0/d3.md"])]
    files = spark.createDataFrame(rows, "path string, content string").withColumn("n_bytes", F.octet_length("content"))
    monkeypatch.setattr(corpus_folder, "SHARE_BYTES", 160_000)
    found, taken, before = {}, [], scratch(spark)["corpus"]
    for root in corpus_folder.write_folders(files):
        assert scratch(spark)["corpus"] == before + 1
        each = [p for p in pathlib.Path(root).rglob("*") if p.is_file()]
        here = {str(p.relative_to(root)): p.read_bytes().replace(derived.BAD_BYTES, b"").decode() for p in each}
        assert not here.keys() & found.keys()
        taken.append(sum(-(-p.stat().st_size // 4096) * 4096 for p in each))
        found |= here
    assert found == texts and len(taken) > 3 and max(taken) < 320_000
    assert scratch(spark)["corpus"] == before


def test_without_files_there_is_one_empty_folder(spark):
    files = spark.createDataFrame([], "path string, content string, n_bytes bigint")
    assert len(list(corpus_folder.write_folders(files))) == 1


@pytest.mark.parametrize("share_bytes", [4 << 30, 100_000])
def test_corpus_text_build_keeps_only_what_is_still_read(spark, tmp_path, monkeypatch, share_bytes):
    """One folder of files at a time, and of records and chunks nothing beside the corpus."""
    part = [(i, f"almond {i}", "7", i % 50) for i in range(1, 60)]
    spark.createDataFrame(part, "p_partkey bigint, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    documents(spark, tmp_path, [(i, " ".join(f"w{i * j % 97}" for j in range(1, 40 * i % 900))) for i in range(40)])
    files = derived.files(spark, str(tmp_path))
    want = corpus_text.cpt_docs(corpus.build_chunks(files)).sort(*corpus.RECORD_ORDER).collect()
    at_once, scan, before = [], corpus.scan_corpus, scratch(spark)
    monkeypatch.setattr(corpus_folder, "SHARE_BYTES", share_bytes)
    monkeypatch.setattr(corpus, "scan_corpus", lambda *a: at_once.append(scratch(spark)["corpus"] - before["corpus"]) or scan(*a))
    found = registry.queries()["corpus_text_build"](spark, str(tmp_path)).sort("place").collect()
    left = scratch(spark) - before
    assert [tuple(row) for row in found] == [(i, row["content"]) for i, row in enumerate(want)] and len(want) > 50
    assert set(at_once) == {1} and (len(at_once) > 2) == (share_bytes < 1 << 30)
    assert left["corpus-text"] == 1 and not [left[k] for k in ("corpus", "records", "chunks", "banded", "numbered") if left[k]]


def test_several_folders_are_one_corpus(spark, tmp_path):
    """Copies in two folders are found, and the order goes through both."""
    text = "module {0} (input a);\n  assign b = a; // " + "words of {0} " * 9 + "\nendmodule"
    for root, name, of in (("x", "b.sv", "one"), ("x", "c.sv", "two"), ("y", "a.sv", "one"), ("y", "d.sv", "three")):
        (tmp_path / root).mkdir(exist_ok=True)
        (tmp_path / root / name).write_text(text.format(of))
    chunks = corpus.build_corpus(spark, (str(tmp_path / root) for root in "xy"), str(tmp_path / "out"))
    assert {(r.source_path, r.module_name) for r in chunks.collect()} == {("a.sv", "one"), ("c.sv", "two"), ("d.sv", "three")}
    read = ordered_corpus.read_ordered(spark, str(tmp_path / "out")).sort("place").collect()
    assert [row.content for row in read] == [text.format(of) for of in ("one", "two", "three")]
