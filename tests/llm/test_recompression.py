import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import queries, recompression, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(rows, window):
    """(key, n, removed, kept words) of each row, by a table of all windows."""
    parts = [(i if i is not None else 1 << 62, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, own in parts:
        for p in range(len(own) - window + 1):
            gram = tuple(own[p : p + window])
            least[gram] = min(least.get(gram, i), i)
    out = []
    for (i, _), (key, own) in zip(rows, parts):
        gone = [False] * len(own)
        for p in range(len(own) - window + 1):
            if least[tuple(own[p : p + window])] < key:
                gone[p : p + window] = [True] * window
        out.append((i, len(own), sum(gone), " ".join(w for w, g in zip(own, gone) if not g)))
    return out


def _order(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def _random_rows(seed, letters):
    draw = random.Random(seed)
    rows = []
    for i in range(60):
        if rows and draw.random() < 0.5:
            _, other = draw.choice(rows)
            own = WORD.findall(other)
            a = draw.randrange(len(own) + 1)
            own = own[a : a + draw.randrange(40)]
        else:
            own = []
        own = [draw.choice(letters) for _ in range(draw.randrange(30))] + own + draw.choices(letters, k=draw.randrange(9))
        rows.append((i, draw.choice([" ", "\n", "\t  "]).join(own)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnop"])
def test_removal_by_hand(spark, letters):
    rows = _random_rows(len(letters), letters)
    rows += [(100, "a " * 300), (101, "a " * 40), (102, None), (103, ""), (None, "a " * 9), (104, rows[0][1]), (104, "zz " + rows[1][1])]
    rows += [(105, rows[2][1]), (105, rows[2][1]), (None, rows[3][1])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, n_words int")
    left = recompression.remove_repeats(table, window=7, joined=True).collect()
    assert _order((r.doc_id, r.n_words, r.n_removed, r.text) for r in left) == _order(by_hand(rows, 7))
    cut = recompression.remove_repeats(table, window=7).collect()
    assert _order((r.doc_id, " ".join(WORD.findall(r.text))) for r in cut) == _order((r.doc_id, r.text) for r in left)
    untouched = {(r.doc_id, r.text) for r in cut if not r.n_removed}
    assert untouched <= {(i, t or "") for i, t in rows}


def test_equal_windows_have_equal_anchors():
    texts = pa.array([t for _, t in _random_rows(1, "abc")] + ["a " * 60, "b a " * 40])
    known = {}
    for part in words.slices(texts, limit=300):
        hashes = words.chain(part.hashes(), 9)
        served = np.zeros(len(part.starts) + 1, int)
        for text, name, begin, end in zip(*recompression.anchors(part, 9)):
            for p in range(begin, end):
                at = p + part.bounds[text]
                served[at] += 1
                assert known.setdefault(hashes[at], name) == name
        for i in range(part.n_texts):
            a, b = part.bounds[i], part.bounds[i + 1]
            assert (served[a : max(a, b - 8)] == 1).all() and not served[max(a, b - 8) : b].any()


def test_empty_table(spark):
    table = spark.createDataFrame([], "doc_id bigint, text string")
    assert recompression.remove_repeats(table).collect() == []


def test_query_by_hand(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = {(i, n, m, hashlib.sha256(kept.encode()).hexdigest()) for i, n, m, kept in by_hand(docs, 50)}
    assert any(m for _, _, m, _ in want)
    assert {tuple(r) for r in queries.queries()["op6_recompression"](spark, folder).collect()} == want
