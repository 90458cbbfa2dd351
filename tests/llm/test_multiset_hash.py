import hashlib

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import multiset_hash as mh
from corpusmill.llm import queries

TEXTS = ["a\nb\nc", "", None, "one line only", "x", "é\n\n日本\nz" * 40, "b\na\nc", "tail\n" * 300, "w" * 9000, "\n\n\n", "a\nb\nc"]


def by_hand(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        n = len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, after))
    return out


@pytest.mark.parametrize("rows_a_bucket", [1, 3, 1000])
def test_edits_by_hand(spark, rows_a_bucket):
    rows = list(enumerate(TEXTS)) + [(None, "no id\nat all"), (4, "x"), (10**15, "far\naway"), (-5, "neg")]
    table = spark.createDataFrame([(*r, "f") for r in rows], "doc_id bigint, text string, fingerprint string")
    made = mh.fingerprint_edits(table, rows_a_bucket=rows_a_bucket).collect()
    want = by_hand(rows)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in made), key=key) == sorted((w[:3] for w in want), key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in made)
    whole = {w[3] for w in want} | {w[4] for w in want} | {w[5] for w in want}
    direct = spark.createDataFrame([(t,) for t in whole], "t string").select("t", mh.as_text(mh.vector(F.col("t"))).alias("v"))
    direct = {r.t: r.v for r in direct.collect()}
    expected = [
        (str(i), direct[text], direct[edited], direct[text] == direct[edited], direct[text] == direct[after])
        for i, _, _, text, edited, after in want
    ]
    got = [(str(r.doc_id), r.fingerprint, r.edited_fingerprint, r.near_edited == 1.0, r.near_next == 1.0) for r in made]
    assert sorted(got) == sorted(expected)


def test_order_insert_delete(spark):
    row = spark.createDataFrame([("a\nb\nb\nc", "c\nb\na\nb", "a\nb\nc", "b")], "p string, q string, r string, s string")
    v = mh.vector
    told = row.select(
        (v(F.col("p")) == v(F.col("q"))).alias("same"),
        (v(F.col("p")) == v(F.col("r"))).alias("counts"),
        (mh.add(v(F.col("r")), v(F.col("s"))) == v(F.col("p"))).alias("inserted"),
        (mh.subtract(v(F.col("p")), v(F.col("s"))) == v(F.col("r"))).alias("deleted"),
    ).first()
    assert (told.same, told.counts, told.inserted, told.deleted) == (True, False, True, True)


def test_likeness_follows_share(spark):
    lines = [f"line {i}" for i in range(60)]
    pairs = [("\n".join(lines), "\n".join(lines[k:] + [f"other {i}" for i in range(k)])) for k in (0, 10, 30, 60)]
    made = spark.createDataFrame(pairs, "a string, b string").select(mh.likeness(mh.vector(F.col("a")), mh.vector(F.col("b"))).alias("x"))
    got = [r.x for r in made.collect()]
    assert got[0] == 1.0 and all(abs(x - w) < 0.35 for x, w in zip(got, (1, 5 / 6, 1 / 2, 0)))


def test_empty_and_single(spark):
    table = spark.createDataFrame([(7, "only\none")], "doc_id bigint, text string")
    row = mh.fingerprint_edits(table).first()
    assert row.near_next == 1.0 and row.n_chars == 8
    assert mh.fingerprint_edits(table.limit(0)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    made = queries.queries()["op4_multiset_hash"](spark, folder)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert {(r.doc_id, r.n_chars, r.edited_sha256) for r in made.collect()} == {w[:3] for w in by_hand(docs)}
