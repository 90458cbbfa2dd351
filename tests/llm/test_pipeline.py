import re

import corpus_pipeline
from corpusmill.llm import pseudonyms, queries
from tests.llm.test_recompression import by_hand as without_repeats
from tests.llm.test_signature_tree import by_hand as grouped

FOLDER = "/root/testdata/sf0.001"


def test_stages_by_hand(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "repeated_passages", "personal_data", "packing"]

    clean = corpus_pipeline.drop_toxic(spark, docs, FOLDER)
    assert clean.schema == docs.schema
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    gone = {r.doc_id for r in docs.collect()} - {i for i, _ in rows}
    assert not [i for i in gone if labels.get(i) == 0]

    single = corpus_pipeline.drop_near_copies(spark, clean, FOLDER)
    assert single.schema == docs.schema
    kept = [(i, t) for (i, t), (_, _, least, _) in zip(rows, grouped(rows)) if i == least]
    assert sorted((r.doc_id, r.text) for r in single.collect()) == sorted(kept)

    cut = corpus_pipeline.cut_repeats(spark, single, FOLDER)
    assert cut.columns == docs.columns
    want = {i: text for i, n, m, text in without_repeats(kept, 50) if m == 0 or m < n}
    found = cut.collect()
    assert {r.doc_id: " ".join(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in found} == want
    assert all(r.n_chars == len(r.text) for r in found)

    hidden = corpus_pipeline.hide_persons(spark, cut, FOLDER)
    assert hidden.columns == docs.columns and hidden.count() == len(found)
    pages = corpus_pipeline.pack(spark, hidden, FOLDER).collect()
    assert sorted(r.doc_id for r in pages) == sorted(want)
    whole = {r.doc_id: (r.n_tokens, r.bucket) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert whole == {r.doc_id: (r.n_tokens, r.bucket) for r in pages}


def test_odd_documents(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "w1 w2", "en", "s", 5), (3, "x " * 120, "en", "s", 240)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, FOLDER)
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "2", "3", "None"]
    empty = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
    assert empty.collect() == []


def test_near_copies_by_row(spark):
    base = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdefg"}
    rows = [
        (1, base["a"]), (None, base["a"] + " more"), (None, base["b"]), (None, base["c"]), (None, None),
        (5, base["a"] + " again"), (5, base["d"]), (5, base["e"]), (5, base["e"]),
        (7, base["f"]), (7, base["f"] + " more"), (None, base["g"]), (None, base["g"] + " more"), (None, base["g"]), (5, ""),
    ]
    docs = spark.createDataFrame([(i, t, "en", str(n), 1) for n, (i, t) in enumerate(rows)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs.repartition(5), FOLDER).collect()]
    one_of = {7: [(7, base["f"]), (7, base["f"] + " more")], None: [(None, base["g"]), (None, base["g"] + " more")]}
    sure = [(1, base["a"]), (None, base["b"]), (None, base["c"]), (None, None), (5, base["d"]), (5, base["e"]), (5, "")]
    assert all(got.count(r) == 1 for r in sure)
    assert all(sum(got.count(r) for r in rows) == 1 for rows in one_of.values())
    assert len(got) == len(sure) + len(one_of)


def test_registered():
    names = queries.queries()
    assert "pipeline" in names and pseudonyms.EXAMPLE_KEY
    assert [n for n in range(1, 14) if sum(q.startswith(f"op{n}_") for q in names) == 1] == list(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None and set(queries.oracle_sql()) == {"op2_url_filter"}
