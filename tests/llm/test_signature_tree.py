import random
import re

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import queries, signature_tree, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=5):
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if len(own) >= n else {tuple(own)} - {()}


def by_hand(rows):
    """(key, n_shingles, component_id, n_links) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(key)
    least = {r: min((k for k in g if k is not None), default=None) for r, g in groups.items()}
    return [(k, len(s), least[find(i)] if s else k, n) for i, ((k, _), s, n) in enumerate(zip(rows, sets, links))]


def _order(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def _rows(seed):
    draw = random.Random(seed)
    base = [[f"w{draw.randrange(400)}" for _ in range(draw.choice([3, 8, 30, 60]))] for _ in range(25)]
    rows = []
    for i in range(160):
        own = list(base[min(draw.randrange(25), draw.randrange(25))])
        for _ in range(draw.choice([0, 0, 1, 1, 2, 5])):
            own[draw.randrange(len(own))] = f"x{draw.randrange(9)}"
        rows.append((i, " ".join(own)))
    # A chain: each like the next, the ends not alike.
    chain = [f"c{i}" for i in range(60)]
    for k in range(12):
        rows.append((200 + k, " ".join(chain[: 60 - k] + [f"d{i}" for i in range(k)])))
    rows += [(300, None), (301, ""), (302, " \n"), (303, "One two"), (304, "one TWO"), (305, "one two three"), (None, rows[0][1])]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (None, "alone without any key here"), (306, "ÄÖ a b c d"), (307, "äö a b c d")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("hot", "block"), [(4096, 1024), (2, 3)])
def test_groups_by_hand(spark, monkeypatch, hot, block):
    # The second case takes the ways of hot n-grams and of large groups.
    monkeypatch.setattr(signature_tree, "HOT_ROWS", hot)
    monkeypatch.setattr(signature_tree, "BLOCK_ROWS", block)
    rows = _rows(3)
    table = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, n bigint")
    found = signature_tree.jaccard_groups(table).collect()
    assert _order(tuple(r) for r in found) == _order(by_hand(rows))


def test_boundary_is_exact(spark):
    # 8 of 10 n-grams shared: exactly 80 percent; 79 of 99: just below.
    rows, linked = [], {}
    for case, (shared, more) in enumerate(((8, 2), (79, 20), (80, 20))):
        left = [f"s{case}.{i}" for i in range(shared + 4)]
        right = left + [f"t{case}.{i}" for i in range(more)]
        assert len(shingles(" ".join(left))) == shared and len(shingles(" ".join(right))) == shared + more
        rows += [(10 * case, " ".join(left)), (10 * case + 1, " ".join(right))]
        linked[10 * case + 1] = 100 * shared >= 80 * (shared + more)
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in signature_tree.jaccard_groups(table).collect()}
    assert {i: found[i] != i for i in linked} == linked == {1: True, 11: False, 21: True}


@pytest.mark.parametrize("seed", range(4))
def test_tree_loses_no_pair(seed):
    draw = np.random.default_rng(seed)
    sets = []
    for _ in range(220):
        if sets and draw.random() < 0.6:
            own = sets[draw.integers(len(sets))].copy()
            own[: max(1, len(own) // 12)] = draw.integers(0, 1 << 60, max(1, len(own) // 12), dtype=np.uint64)
        else:
            own = draw.integers(0, 1 << 60, draw.integers(1, 300), dtype=np.uint64)
        sets.append(np.unique(own))
    size = np.array([len(s) for s in sets])
    bits = np.stack([signature_tree._bitmap(s) for s in sets]).view("<u8")
    pairs = {tuple(sorted(p)) for part in signature_tree._candidates(size, bits, 80) for p in part.tolist()}
    true = {
        (i, j) for j in range(len(sets)) for i in range(j)
        if 100 * (o := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (size[i] + size[j] - o)
    }
    assert true and true <= pairs
    assert len(pairs) < 0.5 * len(sets) * (len(sets) - 1) / 2


def test_groups_across_batches():
    table = pa.table({"token": [1, 1, 1, 2, 3, 3, 3, 3, 4], "x": range(9)})
    for rows in (1, 2, 4, 9):
        parts = list(signature_tree._groups(iter(table.to_batches(max_chunksize=rows)), ["token"]))
        assert [x for p in parts for x in p["x"].to_pylist()] == list(range(9))
        ends = [(p["token"][0].as_py(), p["token"][-1].as_py()) for p in parts]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_empty(spark):
    table = spark.createDataFrame([], "doc_id bigint, text string")
    assert signature_tree.jaccard_groups(table).collect() == []
    assert list(words.slices(pa.array([], pa.string()))) == []


def test_query_by_hand(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = queries.queries()["op9_signature_tree"](spark, folder).collect()
    assert _order(tuple(r) for r in found) == _order(by_hand(docs))
