"""N-gram Jaccard join of whole texts with signature trees.

The set of a text is its distinct word n-grams (as 64-bit values). Texts with
equal sets form a class, and classes are joined:

1. Candidates. Large sets are cut into parts by ranges of n-gram values; if two
   sets have a Jaccard similarity of t or more, then so have the parts of one
   range at least, and parts stay small enough for a bitmap of fixed size. In any
   fixed order of the n-grams, two such parts share one of the first
   |x| - ceil(t |x|) + 1 n-grams of each. The order is by value, with n-grams that
   are frequent in a bounded sample put last; it steers the work, never the
   result. The parts that share such an n-gram meet in a signature tree: leaves
   hold rows of like size, nodes
   the OR of their token bitmaps and the ranges of sizes and of bit counts. A
   dual traversal drops node pairs, and then row pairs, whose greatest possible
   overlap is too small. What is left is kept as a spanning forest, so the links
   of a group never outnumber its rows. An n-gram shared by more rows than
   `HOT_ROWS` links all of them to the first, without any test.
2. Verification. The connected components of these links hold every true pair.
   The sets of each component are gathered once; a large one is dealt into
   blocks that meet pairwise. There a tree is traversed again and the pairs left
   are verified exactly on whole sets.

Pairs themselves are never rows: each task gives a spanning forest of its true
links and each class's number of links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words
from corpusmill.operators.components import components
from corpusmill.runtime import discard, materialize

WORDS_A_SHINGLE = 5
PERCENT = 80
BITMAP_WORDS = 16  # of 64 bits
PART_TOKENS = 512
SAMPLE_ROWS = 2000
MAX_FREQUENT = 1 << 16
HOT_ROWS = 4096
BLOCK_ROWS = 1024
LEAF_ROWS = 32


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit values of a set."""
    return (
        int(words.mix(tokens + np.uint64(11)).sum(dtype=np.uint64).astype(np.int64)),
        int(words.mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)),
    )


def _texts(table: DataFrame, key: str, text: str) -> DataFrame:
    return table.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))


def _frequent(texts: DataFrame, n: int) -> np.ndarray:
    """N-grams that at least two different sets of a sample hold, sorted; a bounded number."""
    share = min(1.0, SAMPLE_ROWS / max(1, texts.count()))
    chosen = texts.filter(F.pmod(F.xxhash64("key", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)))

    def run(batches):
        for batch in batches:
            for part in words.slices(batch["text"]):
                sets = {_digest(s): s for s in words.shingle_sets(part, n, True)}
                tokens = np.concatenate([np.zeros(0, np.uint64), *sets.values()])
                distinct, counts = np.unique(tokens, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct.astype(np.int64)), pa.array(counts)], ["token", "n"]
                )

    counted = chosen.mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    most = counted.filter("n > 1").orderBy(F.col("n").desc(), "token").limit(MAX_FREQUENT)
    return np.sort(most.toPandas()["token"].to_numpy(np.int64).astype(np.uint64))


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _bitmap(tokens: np.ndarray) -> np.ndarray:
    place = (words.mix(tokens) >> np.uint64(40)) % np.uint64(BITMAP_WORDS * 64)
    bits = np.zeros(BITMAP_WORDS * 64, np.uint8)
    bits[place.astype(np.int64)] = 1
    return np.packbits(bits)


def _cuts(n: int, percent: int) -> set[int]:
    """In how many ranges (as a power of two) a set of `n` n-grams is cut.

    Two sets meet where the smaller one is cut as it needs. The larger one is at
    most 100 / percent times as large, so it is cut for its own size and for the
    least size that it can meet.
    """
    return {max(0, (-(-size // PART_TOKENS) - 1).bit_length()) for size in (n, -(-percent * n // 100))}


def parts_of(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(size, bitmap, first n-grams) of each part of a sorted set that is not empty."""
    late = _is_in(tokens, frequent)
    for cut in _cuts(len(tokens), percent):
        limits = np.arange(1, 1 << cut, dtype=np.uint64) << np.uint64(64 - cut) if cut else np.zeros(0, np.uint64)
        bounds = [0, *np.searchsorted(tokens, limits).tolist(), len(tokens)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if a < b:
                own, last = tokens[a:b], late[a:b]
                first = np.concatenate([own[~last], own[last]])[: b - a - -(-percent * (b - a) // 100) + 1]
                # An n-gram of one cut is another one than that of the next.
                named = words.mix(first + np.uint64(cut)) if cut else first
                yield b - a, _bitmap(own).tobytes(), named.tobytes()


def text_mark(text: Column) -> Column:
    """What tells a text from others of the same key."""
    return F.sha2(text.cast("string").cast("binary"), 256)


def sketches(table: DataFrame, key: str, text: str, n: int, percent: int, marked: bool = False) -> DataFrame:
    """(key, mark, n, h1, h2, parts) of every row; an empty set has n = 0 and no parts.

    The mark is that of the whole text if `marked`, or else null.
    """
    texts = _texts(table, key, text)
    frequent = table.sparkSession.sparkContext.broadcast(_frequent(texts, n))

    def run(batches):
        for batch in batches:
            sizes, digests, parts, counts = [], [], [], []
            for part in words.slices(batch["text"]):
                for tokens in words.shingle_sets(part, n, True):
                    own = list(parts_of(tokens, frequent.value, percent))
                    sizes.append(len(tokens))
                    digests.append(_digest(tokens))
                    parts += own
                    counts.append(len(own))
            columns = [
                pa.array([p[0] for p in parts], pa.int32()),
                pa.array([p[1] for p in parts], pa.binary()),
                pa.array([p[2] for p in parts], pa.binary()),
            ]
            offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
            nested = pa.StructArray.from_arrays(columns, ["n", "bitmap", "prefix"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    batch["mark"],
                    pa.array(sizes, pa.int32()),
                    pa.array([a for a, _ in digests], pa.int64()),
                    pa.array([b for _, b in digests], pa.int64()),
                    pa.ListArray.from_arrays(offsets, nested),
                ],
                ["key", "mark", "n", "h1", "h2", "parts"],
            )

    kinds = "key bigint, mark string, n int, h1 bigint, h2 bigint, "
    kinds += "parts array<struct<n int, bitmap binary, prefix binary>>"
    mark = text_mark(F.col("text")) if marked else F.lit(None).cast("string")
    return texts.withColumn("mark", mark).mapInArrow(run, kinds)


class _Forest:
    """Union-find over the rows of one group."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def links(self, pairs: np.ndarray) -> list[tuple[int, int]]:
        """The pairs that join two trees, one after the other."""
        kept = []
        for x, y in pairs.tolist():
            a, b = self.find(x), self.find(y)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                kept.append((x, y))
        return kept


def _reachable(
    size_a: np.ndarray, size_b: np.ndarray, overlap: np.ndarray, percent: int
) -> np.ndarray:
    """Whether an overlap suffices for two sizes: 100 o >= percent (a + b - o)."""
    return (100 + percent) * overlap >= percent * (size_a + size_b)


def row_pairs(rows: np.ndarray, cols: np.ndarray, size: np.ndarray, bits: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs (rows[i], cols[i]) may be similar by size and bitmap."""
    a, b = bits[rows], bits[cols]
    only_a = np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64)
    overlap = np.minimum(size[rows] - only_a, size[cols] - only_b)
    return _reachable(size[rows], size[cols], overlap, percent)


class SignatureTree:
    """Rows sorted by size in leaves; nodes with OR bitmaps and ranges, halving upwards."""

    def __init__(self, size: np.ndarray, bits: np.ndarray) -> None:
        self.order = np.lexsort((bits[:, 0], size))
        starts = np.arange(0, len(size), LEAF_ROWS)
        size, bits = size[self.order], bits[self.order]
        count = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        level = (
            np.minimum.reduceat(size, starts),
            np.maximum.reduceat(size, starts),
            np.minimum.reduceat(count, starts),
            np.bitwise_or.reduceat(bits, starts, axis=0),
        )
        self.levels = [level]
        while len(level[0]) > 1:
            pairs = np.arange(0, len(level[0]), 2)
            level = (
                np.minimum.reduceat(level[0], pairs),
                np.maximum.reduceat(level[1], pairs),
                np.minimum.reduceat(level[2], pairs),
                np.bitwise_or.reduceat(level[3], pairs, axis=0),
            )
            self.levels.append(level)

    def leaf(self, i: int) -> np.ndarray:
        return self.order[i * LEAF_ROWS : (i + 1) * LEAF_ROWS]

    def leaf_pairs(self, percent: int) -> np.ndarray:
        """Pairs of leaves (also of a leaf with itself) that a dual traversal leaves."""
        pairs = np.array([[0, 0]])
        for depth in reversed(range(len(self.levels))):
            low, high, fewest, union = self.levels[depth]
            a, b = pairs[:, 0], pairs[:, 1]
            both = np.bitwise_count(union[a] & union[b]).sum(axis=1, dtype=np.int64)
            # A set of `fewest` bits or more has at least the rest outside of the other node.
            overlap = np.minimum(
                high[a] - np.maximum(0, fewest[a] - both), high[b] - np.maximum(0, fewest[b] - both)
            )
            pairs = pairs[_reachable(low[a], low[b], np.minimum(overlap, np.minimum(high[a], high[b])), percent)]
            if depth:
                n = len(self.levels[depth - 1][0])
                down = np.concatenate([2 * pairs + np.array(step) for step in ((0, 0), (0, 1), (1, 0), (1, 1))])
                pairs = down[(down[:, 0] <= down[:, 1]) & (down[:, 1] < n)]
                pairs = np.unique(pairs, axis=0)
        return pairs


def _candidates(size: np.ndarray, bits: np.ndarray, percent: int) -> Iterator[np.ndarray]:
    """Pairs of rows that may be similar, leaf pair by leaf pair."""
    tree = SignatureTree(size, bits)
    for a, b in tree.leaf_pairs(percent):
        left, right = tree.leaf(a), tree.leaf(b)
        x, y = np.repeat(left, len(right)), np.tile(right, len(left))
        own = x < y if a == b else np.ones(len(x), bool)
        x, y = x[own], y[own]
        near = row_pairs(x, y, size, bits, percent)
        yield np.stack([x[near], y[near]], axis=1)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows that are sorted by `keys`, many small ones at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        change = _changes(table, keys)
        if len(change):
            cut = int(change[-1])
            yield table.slice(0, cut).combine_chunks()
            held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Rows at which a new group begins, without the first."""
    change = np.zeros(table.num_rows - 1, bool)
    for key in keys:
        values = table[key].to_numpy()
        change |= values[1:] != values[:-1]
    return np.flatnonzero(change) + 1


def _matrix(column: pa.ChunkedArray, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _tree_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Spanning links of the rows of each token that may be similar."""
    for table in _groups(batches, ["token"]):
        ids, size = table["cid"].to_numpy(), table["n"].to_numpy().astype(np.int64)
        bits = _matrix(table["bitmap"], BITMAP_WORDS, "<u8")
        bounds = np.concatenate([[0], _changes(table, ["token"]), [table.num_rows]])
        lengths = np.diff(bounds)
        links = []
        # Groups of up to a leaf's rows: all their pairs at once, by distance within the group.
        small = np.repeat(lengths <= LEAF_ROWS, lengths)
        group = np.repeat(np.arange(len(lengths)), lengths)
        for step in range(1, min(LEAF_ROWS, len(ids))):
            x = np.flatnonzero(small[:-step] & (group[step:] == group[:-step]))
            if not len(x):
                break
            x = x[row_pairs(x, x + step, size, bits, percent)]
            links.append(np.stack([ids[x], ids[x + step]], axis=1))
        for g in np.flatnonzero(lengths > LEAF_ROWS):
            at, to = bounds[g], bounds[g + 1]
            forest = _Forest(to - at)
            for pairs in _candidates(size[at:to], bits[at:to], percent):
                kept = np.array(forest.links(pairs), np.int64).reshape(-1, 2)
                links.append(ids[at + kept])
        found = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *links]), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def candidate_links(parts: DataFrame, percent: int) -> DataFrame:
    """(a, b) links whose components hold all pairs of classes that may be similar.

    `parts` has (pid, cid, n, bitmap, prefix) and is a written table.
    """

    def spread(batches):
        for batch in batches:
            prefixes = batch["prefix"].to_pylist()
            counts = [len(p) // 8 for p in prefixes]
            tokens = np.frombuffer(b"".join(prefixes), np.int64)
            ids = np.repeat(batch["pid"].to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(ids)], ["token", "pid"])

    rows = parts.select("pid", "prefix").mapInArrow(spread, "token bigint, pid bigint")
    shared = rows.groupBy("token").agg(F.count("*").alias("rows"), F.min("pid").alias("first"))
    shared = shared.filter("rows > 1")
    rows = materialize(rows.join(shared, "token"), "prefixes")
    discard()
    owners = parts.select("pid", "cid")
    hot = rows.filter((F.col("rows") > HOT_ROWS) & (F.col("pid") != F.col("first"))).select("first", "pid")
    hot = hot.distinct().join(owners, "pid").withColumnRenamed("cid", "b").drop("pid")
    hot = hot.join(owners.toDF("first", "a"), "first").select("a", "b")
    ordinary = rows.filter(F.col("rows") <= HOT_ROWS).select("token", "pid")
    ordinary = ordinary.join(parts.select("pid", "cid", "n", "bitmap"), "pid").drop("pid")
    ordinary = ordinary.repartition("token").sortWithinPartitions("token", "n", "cid")
    links = ordinary.mapInArrow(lambda batches: _tree_links(batches, percent), "a bigint, b bigint")
    links = materialize(links.unionByName(hot).filter("a <> b").distinct(), "candidates")
    discard(rows)
    return links


def _overlaps(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as a product of incidence matrices over the shared tokens."""
    mine, yours = np.concatenate(sets), np.concatenate(others)
    shared = np.intersect1d(mine, yours)
    total = np.zeros((len(sets), len(others)))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    other = np.repeat(np.arange(len(others)), [len(s) for s in others])
    for at in range(0, len(shared), 8192):
        part = shared[at : at + 8192]
        total += _incidence(mine, owner, len(sets), part) @ _incidence(yours, other, len(others), part).T
    return total.astype(np.int64)


def _incidence(tokens: np.ndarray, owner: np.ndarray, n: int, columns: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(columns, tokens), len(columns) - 1)
    known = columns[at] == tokens
    made = np.zeros((n, len(columns)), np.float32)
    made[owner[known], at[known]] = 1
    return made


def _verified(group: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spanning true links (ids), ids, and the copies that each id links to."""
    ids, copies, block = (group[c].to_numpy() for c in ("cid", "copies", "block"))
    sets = [np.frombuffer(b, np.uint64) for b in group["tokens"].to_pylist()]
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    bits = np.stack([_bitmap(s) for s in sets]).view("<u8")
    across = group["i"][0].as_py() != group["j"][0].as_py()
    tree, forest, links = SignatureTree(size, bits), _Forest(len(ids)), []
    number = np.zeros(len(ids), np.int64)
    for a, b in tree.leaf_pairs(percent):
        left, right = tree.leaf(a), tree.leaf(b)
        overlap = _overlaps([sets[i] for i in left], [sets[i] for i in right])
        true = _reachable(size[left][:, None], size[right][None, :], overlap, percent)
        if across:
            true &= block[left][:, None] != block[right][None, :]
        if a == b:
            true = np.triu(true, 1)
        x, y = np.nonzero(true)
        x, y = left[x], right[y]
        np.add.at(number, x, copies[y])
        np.add.at(number, y, copies[x])
        links += forest.links(np.stack([x, y], axis=1))
    return ids[np.array(links, np.int64).reshape(-1, 2)], ids, number


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    keys = ["comp", "i", "j"]
    for table in _groups(batches, keys):
        bounds = np.concatenate([[0], _changes(table, keys), [table.num_rows]])
        links, ids, numbers = [np.zeros((0, 2), np.int64)], [], []
        for at, to in zip(bounds[:-1], bounds[1:], strict=True):
            found, own, number = _verified(table.slice(at, to - at), percent)
            links.append(found)
            ids.append(own)
            numbers.append(number)
        pairs = np.concatenate(links)
        own, number = np.concatenate(ids), np.concatenate(numbers)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([pairs[:, 0], own])),
                pa.array([*pairs[:, 1].tolist(), *[None] * len(own)], pa.int64()),
                pa.array(np.concatenate([np.zeros(len(pairs), np.int64), number])),
            ],
            ["a", "b", "n_links"],
        )


def true_links(
    table: DataFrame, classes: DataFrame, clusters: DataFrame, key: str, text: str, n: int, percent: int
) -> DataFrame:
    """(a, b, n_links): spanning true links, and rows without b with each class's links."""
    sizes = clusters.groupBy("root").agg((F.count("*") + 1).alias("rows"))
    sizes = sizes.withColumn("blocks", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int"))
    members = clusters.unionByName(sizes.select(F.col("root").alias("node"), "root"))
    members = members.join(sizes.select("root", "blocks"), "root").withColumnRenamed("node", "cid")
    members = members.join(classes.select("cid", "rep", "copies", "h1", "h2"), "cid")
    members = materialize(members, "members")
    texts = _texts(table, key, text)
    wanted = members.select(F.col("rep").alias("wanted")).distinct()
    texts = texts.join(wanted, texts["key"].eqNullSafe(wanted["wanted"]), "left_semi")

    def run(batches):
        for batch in batches:
            sets = [s for part in words.slices(batch["text"]) for s in words.shingle_sets(part, n, True)]
            digests = [_digest(s) for s in sets]
            columns = [
                pa.array([a for a, _ in digests], pa.int64()),
                pa.array([b for _, b in digests], pa.int64()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "tokens"])

    sets = texts.select("text").mapInArrow(run, "h1 bigint, h2 bigint, tokens binary")
    rows = sets.join(members, ["h1", "h2"]).dropDuplicates(["cid"])
    block = F.pmod(F.xxhash64("cid", F.lit(3)), F.col("blocks")).cast("int")
    rows = rows.select("cid", "copies", "tokens", F.col("root").alias("comp"), "blocks", block.alias("block"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select(
        "comp",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "cid",
        "copies",
        "block",
        "tokens",
    )
    rows = rows.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "cid")
    return rows.mapInArrow(lambda batches: _verify(batches, percent), "a bigint, b bigint, n_links bigint")


def jaccard_groups(
    table: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = WORDS_A_SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """(key, n_shingles, component_id, n_links), a row for each row of `table`.

    A-Z count in lower case; a text of fewer than `n` words is one shingle. Two
    rows link when 100 |x and y| >= percent |x or y|. `component_id` is the least
    key that links reach, `n_links` the number of other rows a row links with.
    Rows without words have no shingles, link with nothing and are components of
    their own. A null key is never a component's id unless all keys are null.
    Repeated rows link with each other; an empty table gives an empty result.
    """
    rows = _joined(table, key, text, n, percent)
    empty = F.col("n") == 0
    return rows.select(
        F.col("key").alias(key),
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(empty, F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, 0).otherwise(F.col("n_links")).alias("n_links"),
    )


def surplus_rows(
    table: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = WORDS_A_SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """(key, mark, surplus), a row for each row of `table`: `surplus` are all rows of a component but one.

    Components are those of `jaccard_groups`, told apart even where they have the
    same least key. The row that stays has the least key, nulls last, and of equal
    keys the least `text_mark`; rows with the same key and text stay or go
    together. Rows without words stay.
    """
    rows = _joined(table, key, text, n, percent, marked=True)
    stays = _rank() == F.col("foremost")
    return rows.select(F.col("key").alias(key), "mark", F.coalesce(~stays, F.lit(False)).alias("surplus"))


def _rank() -> Column:
    """The order of rows in a component."""
    return F.struct(F.col("key").isNull().alias("last"), "key", "mark")


def _joined(table: DataFrame, key: str, text: str, n: int, percent: int, marked: bool = False) -> DataFrame:
    """(key, mark, n, component_id, foremost, n_links) of every row; the last three are null without words."""
    if not 50 < percent <= 100:
        raise ValueError("percent must lie above 50")
    sketched = materialize(sketches(table, key, text, n, percent, marked), "sketches")
    known = materialize(sketched.select("key", "mark", "n", "h1", "h2"), "digests")
    classes = sketched.filter("n > 0").groupBy("h1", "h2").agg(
        F.min("key").alias("rep"),
        F.min(_rank()).alias("foremost"),
        F.count("*").alias("copies"),
        F.first("parts").alias("parts"),
    )
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    discard(sketched)
    parts = classes.select("cid", F.explode("parts").alias("part")).select("cid", "part.*")
    parts = materialize(parts.withColumn("pid", F.monotonically_increasing_id()), "parts")
    classes = materialize(classes.drop("parts"), "class-ids")
    candidates = candidate_links(parts, percent)
    discard(parts)
    clusters = components(candidates)
    links = materialize(true_links(table, classes, clusters, key, text, n, percent), "links")
    discard(candidates)
    roots = components(links.filter("b is not null"))
    numbers = links.filter("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n_links").alias("others"))
    labelled = classes.select("cid", "rep", "foremost", "copies", "h1", "h2").join(
        roots.withColumnRenamed("node", "cid"), "cid", "left"
    )
    labelled = labelled.join(numbers, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = labelled.groupBy("root").agg(F.min("rep").alias("component_id"), F.min("foremost").alias("foremost"))
    labelled = labelled.drop("foremost").join(least, "root").select(
        "h1",
        "h2",
        "component_id",
        "foremost",
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
    )
    rows = known.join(labelled, ["h1", "h2"], "left")
    wordless = F.col("n") == 0
    return rows.select(
        "key",
        "mark",
        "n",
        *[F.when(~wordless, F.col(c)).alias(c) for c in ("component_id", "foremost", "n_links")],
    )
