import itertools
import random

from tokenizers import Tokenizer

from corpusmill.llm import bpe, packing, queries


def padding(histogram, bounds):
    return sum(n * min(b for b in bounds if b >= length) for length, n in histogram)


def test_bounds_by_hand():
    draw = random.Random(1)
    for _ in range(300):
        n = draw.randint(1, 9)
        histogram = sorted((length, draw.randint(1, 5)) for length in draw.sample(range(30), n))
        k = draw.randint(1, 5)
        lengths = [length for length, _ in histogram]
        best = min(
            padding(histogram, [*chosen, lengths[-1]])
            for r in range(min(k, n)) for chosen in itertools.combinations(lengths[:-1], r)
        )
        bounds = packing.best_bounds(histogram, k)
        assert len(bounds) <= k and bounds == sorted(bounds)
        assert padding(histogram, bounds) == best
    assert packing.best_bounds([], 4) == []


def _check(rows, lengths, budget, buckets):
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == sorted((str(i), max(0, n or 0)) for i, n in lengths)
    assert len({r.bucket for r in rows}) <= buckets
    batches = {}
    for r in rows:
        assert r.n_tokens <= r.padded_to
        batches.setdefault((r.bucket, r.batch), []).append(r)
    last = {}
    for bucket, batch in batches:
        last[bucket] = max(last.get(bucket, 0), batch)
    for (bucket, batch), own in batches.items():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        full = max(1, budget // max(1, own[0].padded_to))
        assert len({r.padded_to for r in own}) == 1
        assert len(own) == full if batch < last[bucket] else 0 < len(own) <= full


def test_batches(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_A_GROUP", 7)
    draw = random.Random(2)
    lengths = [(i, int(draw.lognormvariate(4, 1))) for i in range(700)] + [(i, 50) for i in range(1000, 1400)]
    lengths += [(2000, None), (2001, 0), (2002, -4), (2003, 10**7), (2004, 5000), (2004, 5000), (None, 12), (None, 12)]
    table = spark.createDataFrame([(*r, "b") for r in lengths], "doc_id bigint, n_tokens bigint, bucket string")
    for budget, buckets in ((600, 4), (16384, 16), (1, 1)):
        rows = packing.pack(table, budget=budget, buckets=buckets).collect()
        _check(rows, lengths, budget, buckets)
    again = packing.pack(table.repartition(5), budget=600, buckets=4).collect()
    first = packing.pack(table, budget=600, buckets=4).collect()
    assert sorted(map(str, again)) == sorted(map(str, first))


def test_a_third_of_the_rows_under_one_id(spark, monkeypatch):
    """Equal rows are counted, and numbered in pieces: no group holds more than a few hundred rows."""
    monkeypatch.setattr(packing, "ROWS_A_GROUP", 100)
    lengths = [(i, 1 + i % 90) for i in range(6000)] + [(None, 40)] * 3000
    table = spark.createDataFrame(lengths, "doc_id bigint, n_tokens bigint").repartition(6)
    made = packing.pack(table, budget=2000, buckets=3)
    _check(made.collect(), lengths, 2000, 3)


def test_tokens_of_a_vocabulary(spark):
    texts = [(1, "antidisestablishmentarianism, 12345"), (2, None), (3, ""), (4, "word"), (4, "word")]
    table = spark.createDataFrame(texts, "doc_id bigint, text string")
    vocabulary = bpe.broadcast_vocabulary(spark)
    counted = {r.doc_id: r.n_tokens for r in bpe.token_digests(table, vocabulary).collect()}
    rows = packing.pack_texts(table, vocabulary).collect()
    assert len(rows) == 5 and all(r.n_tokens == counted[r.doc_id] for r in rows) and counted[1] > 4


def test_histogram_keeps_whole_lengths(spark):
    table = spark.createDataFrame([(1, 5001), (2, 5000), (3, 70001), (4, 3)], "doc_id bigint, n_tokens bigint")
    rows = {r.doc_id: r.padded_to for r in packing.pack(table, buckets=9).collect()}
    assert rows[1] in (5000, 5001) and rows[3] == 70001 and rows[4] == 3


def test_empty_and_texts(spark):
    table = spark.createDataFrame([(1, "a  b\tc\nd"), (2, None), (3, " \n"), (4, "x y")], "doc_id bigint, text string")
    assert packing.pack_texts(table.limit(0)).collect() == []
    assert {r.doc_id: r.n_tokens for r in packing.pack_texts(table).collect()} == {1: 4, 2: 0, 3: 0, 4: 1}


def test_query(spark):
    """Lengths are those of the tokenizers library."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    tokenizer = Tokenizer.from_file(bpe.tokenizer_path())
    encoded = tokenizer.encode_batch([r.text or "" for r in docs], add_special_tokens=False)
    rows = queries.queries()["op10_packing"](spark, folder).collect()
    _check(rows, [(r.doc_id, len(e.ids)) for r, e in zip(docs, encoded)], packing.BUDGET, packing.BUCKETS)
