import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpusmill.llm import bpe, queries

ODD = [
    "", " ", "  a", "a  b\n\n c\x1c\x85  x", "<|endoftext|>a<|endoftext|>", "don't we'll I'Ve 'S", "a" * 3000, "ab" * 300,
    "é" * 99 + "١٢٣ ½ Ⅷ", "日本語テキスト 😀😀👩‍👩‍👧", "  x　y \t\r\n", "x\u200by _ __ ___ ́a", "\U00010400𝟘𞤀", "\x00\x01 \x1f\x1d k",
    "<|endoftext", "naïve café ÿ", "\u2028\u2029\u3000", "aaaa aaaaa aaaaaaa", " \n ", "\xa0\xa0x",
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.tokenizer_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.tokenizer_path())


def test_like_the_library(vocabulary, library):
    encoder = bpe.Encoder(vocabulary)
    ids, counts = encoder.encode(ODD)
    for text, own in zip(ODD, np.split(ids, np.cumsum(counts)[:-1])):
        want = library.encode(text, add_special_tokens=False).ids
        assert own.tolist() == want, text
        assert bpe.decode(vocabulary, own).decode() == library.decode(want, skip_special_tokens=False)


def test_broken_bytes_decode_alike(vocabulary, library):
    for ids in ([447], [447, 121, 65], [50256, 200, 201], list(range(256))):
        want = library.decode(ids, skip_special_tokens=False)
        assert bpe.decode(vocabulary, np.array(ids, np.uint32)).decode() == want


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    encoder = bpe.Encoder(vocabulary)
    first = [encoder.encode([t])[0].tolist() for t in ODD + ODD]
    assert first[: len(ODD)] == first[len(ODD) :]


def test_round_trip_and_rows(spark, vocabulary):
    shared = spark.sparkContext.broadcast(vocabulary)
    rows = [(i, t, [1]) for i, t in enumerate(ODD)] + [(99, None, None), (None, "x", None), (0, "", None)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, ids array<int>")
    encoded = bpe.encode_texts(table, shared)
    decoded = bpe.decode_ids(encoded, shared).collect()
    assert sorted((str(r.doc_id), r.text) for r in decoded) == sorted((str(i), t or "") for i, t, _ in rows)
    assert bpe.token_digests(table.limit(0), shared).collect() == []
    digest = {r.doc_id: r for r in bpe.token_digests(table, shared).collect()}
    assert digest[99].n_tokens == 0 and digest[99].ids_sha256 == hashlib.sha256(b"").hexdigest()


def test_query_by_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.queries()["op5_bpe"](spark, folder).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode(docs[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
