"""The prefix trie of conversations, from sorted conversations and their common prefixes.

A node is a distinct sequence of first turns. In sorted order the members of a
node stand together, from the first to the last row whose neighbours share at
least its depth (LCP). So no trie is built: a sparse table over the LCPs of a
block gives the least LCP of any range, and every candidate prefix (a row and a
depth) finds its left and right extent by two binary searches over it, each for
itself and without a stack. What a node needs of its members and of its subtree
are sums and least values over its extent.

To stay bounded, a conversation is cut into segments of `SEGMENT` turns, each
keyed by the digest of all turns before it, and the sorted segments into blocks
of `BLOCK` rows; extents that run over the edge of a block are parts, which
Spark adds up by the digest of the node's prefix. Turns are 128-bit digests from
the start; texts are read once and never sorted or shipped. Places of turns are
counted within range partitions and then by the partitions' counts, so a
conversation that holds most turns is spread over many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.runtime import discard, materialize

SEGMENT = 64
BLOCK = 4096
#: Fixed values of the rebuilding: a conversation takes its first turns from the first of its family.
FAMILY, HEADS = 20, 4
WORDS = r"[^\x20\x09-\x0D]+"
_PREFIX = ["depth", "a", "b"]


def _wrapped(total: Column) -> Column:
    """A decimal sum modulo 2^64, as a signed bigint."""
    half, whole = (F.lit(str(1 << bits)).cast("decimal(20,0)") for bits in (63, 64))
    return (F.pmod(total + half, whole) - half).cast("bigint")


def _wide(number: Column) -> Column:
    return number.cast("decimal(20,0)")


# ---- conversations as digests of turns ----------------------------------------
def number_turns(table: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, gid, digest, words) in order of conversation and turn; `gid` rises by one inside a partition."""
    said, who = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (text, role))
    turns = table.filter(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("bigint").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        who.alias("role"),
        F.unhex(F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said).cast("binary"))).alias("digest"),
        F.regexp_count(said, F.lit(WORDS)).cast("bigint").alias("words"),
    )
    order = ["conv", "turn", "role", "digest"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select("conv", "digest", "words", F.monotonically_increasing_id().alias("gid"))
    return materialize(ranged, "turns")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, total) of the rebuilt conversations, and their turns (conv, total, place, digest, words)."""
    part = F.shiftright("gid", 33)
    sizes = turns.groupBy("conv", part.alias("part")).agg(F.min("gid").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    sizes = materialize(sizes, "turn-counts")
    lengths = sizes.groupBy("conv").agg(F.sum("n").alias("n_own"))
    heads = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("bigint")
    family = lengths.select(F.col("conv").alias("base"), F.col("n_own").alias("n_base"))
    convs = lengths.select("*", heads.alias("head"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    shift = F.least("head", F.coalesce("n_base", F.lit(0)))
    convs = convs.join(family, "base", "left").select("conv", "base", "head", shift.alias("shift"), "n_own")
    convs = convs.withColumn("total", F.col("shift") + F.greatest(F.lit(0), F.col("n_own") - F.col("head")))
    convs = materialize(convs, "conversations")

    places = sizes.join(convs.select("conv", "head", "shift", "total"), "conv")
    index = (F.col("gid") - F.col("first") + F.col("before")).alias("index")
    placed = turns.withColumn("part", part).join(places, ["conv", "part"])
    placed = placed.select("conv", index, "head", "shift", "total", "digest", "words")
    own = placed.filter("index >= head").select(
        "conv", "total", (F.col("index") - F.col("head") + F.col("shift")).alias("place"), "digest", "words"
    )
    taken = placed.filter(F.col("index") < HEADS - 1).select(F.col("conv").alias("base"), "index", "digest", "words")
    taken = convs.filter("shift > 0").select("conv", "base", "shift", "total").join(taken, "base").filter("index < shift")
    taken = taken.select("conv", "total", F.col("index").alias("place"), "digest", "words")
    return convs, own.unionByName(taken)


def segments(convs: DataFrame, turns: DataFrame, segment: int) -> DataFrame:
    """(r, ka, kb, turns, more, conv, total): turns r * segment on of a conversation, at most `segment`.

    (ka, kb) is the digest of all turns before, a sum over their places modulo
    2^64; `more` tells whether turns follow. A turnless conversation has one
    segment without turns.
    """
    turns = turns.select(
        "conv", "total", (F.col("place") / segment).cast("bigint").alias("r"), "place", "words",
        F.xxhash64("digest", "place", F.lit(1)).alias("a"), F.xxhash64("digest", "place", F.lit(2)).alias("b"),
    )
    cut = turns.groupBy("conv", "r").agg(
        F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("place", "a", "b", "words"))).alias("turns"),
        F.sum(_wide(F.col("a"))).alias("sa"),
        F.sum(_wide(F.col("b"))).alias("sb"),
    )
    before = Window.partitionBy("conv").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    key = lambda c: _wrapped(F.coalesce(F.sum(c).over(before), F.lit(0)))
    shared = ["r", "ka", "kb", "turns", "more", "conv", "total"]
    long = cut.filter(F.col("total") > segment).withColumns({"ka": key("sa"), "kb": key("sb")})
    zero = F.lit(0).cast("bigint")
    short = cut.filter(F.col("total") <= segment).withColumns({"ka": zero, "kb": zero})
    found = long.unionByName(short).select(
        "r", "ka", "kb", "conv", "total",
        (F.col("total") > (F.col("r") + 1) * segment).alias("more"),
        F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["words"].alias("words"))).alias("turns"),
    )
    bare = convs.filter("total = 0").select(
        zero.alias("r"), zero.alias("ka"), zero.alias("kb"), "conv", "total", F.lit(False).alias("more"),
        F.array().cast(found.schema["turns"].dataType).alias("turns"),
    )
    return found.unionByName(bare).select(*shared)


# ---- common prefixes of sorted neighbours -------------------------------------
def _turn_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, both digests and words of a list column."""
    flat = column.flatten()
    offsets = column.offsets.to_numpy()
    a, b, words = (flat.field(i).to_numpy() for i in range(3))
    return (offsets - offsets[0]).astype(np.int64), a.view(np.uint64), b.view(np.uint64), words


def neighbour_lcps(rows: pa.RecordBatch, segment: int) -> np.ndarray:
    """Turns that each row shares with the next, counted from the conversation's start; -1 for other keys."""
    r, ka, kb = (rows[c].to_numpy() for c in ("r", "ka", "kb"))
    offsets, a, b, _ = _turn_arrays(rows["turns"])
    sizes = np.diff(offsets)
    least = np.minimum(sizes[:-1], sizes[1:])
    before = np.cumsum(least) - least
    place = np.arange(least.sum()) - np.repeat(before, least)
    one, other = np.repeat(offsets[:-2], least) + place, np.repeat(offsets[1:-1], least) + place
    differs = np.where((a[one] == a[other]) & (b[one] == b[other]), segment, place)
    common, some = least.copy(), least > 0
    if some.any():
        common[some] = np.minimum(least[some], np.minimum.reduceat(differs, before[some]))
    alike = (r[:-1] == r[1:]) & (ka[:-1] == ka[1:]) & (kb[:-1] == kb[1:])
    return np.where(alike, r[:-1] * segment + common, -1)


def sorted_neighbours(cut: DataFrame, segment: int) -> DataFrame:
    """Segments with `part` and `row` in sorted order, and the LCPs with the rows before and after."""
    order = ["r", "ka", "kb", "turns", "more", "conv"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, held, left = TaskContext.get().partitionId(), 0, None, None

        def finished(rows: pa.RecordBatch, lefts: list, rights: list) -> pa.RecordBatch:
            n = len(rows)
            places = [pa.array(np.full(n, part, np.int64)), pa.array(np.arange(at, at + n))]
            links = [pa.array(lefts, pa.int64()), pa.array(rights, pa.int64())]
            return pa.RecordBatch.from_arrays([*rows.columns, *places, *links], [*rows.schema.names, "part", "row", "left", "right"])

        for batch in batches:
            if not len(batch):
                continue
            whole = batch
            if held is not None:
                whole = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            lcps = neighbour_lcps(whole, segment).tolist()
            if lcps:
                yield finished(whole.slice(0, len(lcps)), [left, *lcps[:-1]], lcps)
                at, left = at + len(lcps), lcps[-1]
            held = whole.slice(len(whole) - 1)
        if held is not None:
            yield finished(held, [left], [None])

    ranged = cut.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema)
    linked = ranged.mapInArrow(run, schema + ", part bigint, row bigint, left bigint, right bigint")
    linked = materialize(linked, "sorted")
    # Rows at the edges of partitions, two each at most, meet across them.
    across = Window.orderBy("part", "row")
    edges = linked.filter("left is null or right is null")

    def shared(move) -> Column:
        same = F.zip_with("turns", move("turns"), lambda x, y: F.coalesce(x == y, F.lit(False)))
        unlike = F.array_position(same, False)
        common = F.when(unlike == 0, F.size("turns")).otherwise(unlike - 1)
        alike = (F.col("r") == move("r")) & (F.col("ka") == move("ka")) & (F.col("kb") == move("kb"))
        return F.when(alike, F.col("r") * segment + common).otherwise(-1)

    edges = edges.select(
        F.col("part").alias("e_part"), F.col("row").alias("e_row"),
        F.coalesce("left", shared(lambda c: F.lag(c).over(across))).alias("e_left"),
        F.coalesce("right", shared(lambda c: F.lead(c).over(across))).alias("e_right"),
    )
    at_edge = (F.col("part") == F.col("e_part")) & (F.col("row") == F.col("e_row"))
    links = {"left": F.coalesce("left", "e_left"), "right": F.coalesce("right", "e_right")}
    return linked.join(F.broadcast(edges), at_edge, "left").withColumns(links).drop("e_part", "e_row", "e_left", "e_right")


def with_sums(linked: DataFrame, segment: int) -> DataFrame:
    """`own`, the words of nodes whose first row this is; and over this and the conversation's later
    segments `surplus`, words that repeat those of an earlier row, and `leaves`, of nodes that end here last."""
    start = F.greatest(F.lit(0), F.col("left") - F.col("r") * segment)
    words = lambda turns: F.aggregate(turns, F.lit(0).cast("bigint"), lambda s, t: s + t["words"])
    new = F.slice("turns", (start + 1).cast("int"), F.greatest(F.lit(0), F.size("turns") - start).cast("int"))
    ends_last = ~F.col("more") & (F.col("right") < F.col("r") * segment + F.size("turns"))
    rows = linked.withColumn("own", words(new)).withColumns(
        {"surplus": words(F.col("turns")) - F.col("own"), "leaves": ends_last.cast("bigint")}
    )
    on = Window.partitionBy("conv").orderBy(F.desc("r")).rowsBetween(Window.unboundedPreceding, 0)
    later = rows.filter(F.col("total") > segment).select(
        "conv", "r", F.sum("surplus").over(on).alias("surplus"), F.sum("leaves").over(on).alias("leaves")
    )
    long = rows.filter(F.col("total") > segment).drop("surplus", "leaves").join(later, ["conv", "r"])
    return rows.filter(F.col("total") <= segment).unionByName(long)


# ---- extents ------------------------------------------------------------------
class SparseTable:
    """Least values of ranges: level k holds those of 2^k entries from each place."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            step, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Of the entries low..high, both included."""
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), self.levels[0].dtype)
        for k in np.unique(level):
            own = level == k
            values = self.levels[k]
            out[own] = np.minimum(values[low[own]], values[high[own] - (1 << int(k)) + 1])
        return out

    def first(self, place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The least l with all entries l+1..place at least `depth`, by binary search."""
        at = place.copy()
        for k in reversed(range(len(self.levels))):
            to = at - (1 << k)
            ok = to >= 0
            ok[ok] = self.levels[k][to[ok] + 1] >= depth[ok]
            at[ok] = to[ok]
        return at

    def last(self, place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The greatest r with all entries place+1..r at least `depth`, by binary search."""
        n, at = len(self.levels[0]), place.copy()
        for k in reversed(range(len(self.levels))):
            to = at + (1 << k)
            ok = to < n
            ok[ok] = self.levels[k][at[ok] + 1] >= depth[ok]
            at[ok] = to[ok]
        return at


def block_nodes(block: pa.Table, segment: int) -> pa.Table:
    """The nodes of a block's rows, with what these rows add to each."""
    block = block.sort_by("row").combine_chunks()
    column = lambda c: block[c].chunk(0)
    r, conv, left, own, surplus, leaves = (
        column(c).to_numpy() for c in ("r", "conv", "left", "own", "surplus", "leaves")
    )
    offsets, a, b, words = _turn_arrays(column("turns"))
    sizes = np.diff(offsets)
    # Every prefix of every row is a candidate: its turns by place, and for rows at the start the root.
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - offsets[row]
    roots = np.flatnonzero(r == 0)
    row, place = np.concatenate([row, roots]), np.concatenate([place, np.full(len(roots), -1)])
    depth = r[row] * segment + place + 1
    lcps = SparseTable(left)
    first, last = lcps.first(row, depth), lcps.last(row, depth)
    kept = first == row
    first, last, depth, place = first[kept], last[kept], depth[kept], place[kept]
    at = offsets[first] + place
    inner = place >= 0

    def before(values: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(values)])

    def within(values: np.ndarray) -> np.ndarray:
        total = before(values)
        return total[last + 1] - total[first]

    def keys(own_key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        start = own_key.view(np.uint64)[first] - total[offsets[first]]
        own, parent = start.copy(), np.zeros(len(first), np.uint64)
        own[inner] += total[at[inner] + 1]
        parent[inner] = start[inner] + total[at[inner]]
        own[~inner] = 0
        return own.view(np.int64), parent.view(np.int64)

    own_a, parent_a = keys(column("ka").to_numpy(), a)
    own_b, parent_b = keys(column("kb").to_numpy(), b)
    counted, members = before(words), last - first + 1
    start, end = counted[offsets[first]], counted[offsets[first + 1]]
    passed = np.where(inner, counted[np.maximum(at, offsets[first])] - start, 0)
    # The node's first row of all repeats nothing from this depth on.
    opens = left[first] < depth
    saved = within(surplus) - members * passed + np.where(opens, own[first] - (end - start - passed), 0)
    return pa.table(
        {
            "depth": depth, "a": own_a, "b": own_b, "parent_a": parent_a, "parent_b": parent_b,
            "n_convs": members.astype(np.int64), "conv_id": SparseTable(conv).least(first, last),
            "saved_tokens": saved, "n_leaves": within(leaves),
        }
    )


def _end_digests(rows: DataFrame, segment: int) -> DataFrame:
    """(depth, a, b, ends_sha256): of the conversations that end at a node, in order.

    A node's ids stream through one hash, as a SHA-256 has to be; none is held.
    """
    ended = rows.filter(~F.col("more"))
    sums = {
        c: _wrapped(F.aggregate("turns", F.col(f"k{c}").cast("decimal(30,0)"), lambda s, t: (s + _wide(t[c])).cast("decimal(30,0)")))
        for c in ("a", "b")
    }
    ended = ended.select(F.col("total").alias("depth"), sums["a"].alias("a"), sums["b"].alias("b"), "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            columns = [batch[c].to_numpy() for c in _PREFIX]
            fresh = np.zeros(len(batch), bool)
            for c in columns:
                fresh[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(fresh).tolist(), len(batch)]
            ids, done = batch["conv"].to_pylist(), []
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                key, told = tuple(int(c[i]) for c in columns), ",".join(map(str, ids[i:j]))
                if key == current:
                    digest.update(b"," + told.encode())
                    continue
                if current:
                    done.append((*current, digest.hexdigest()))
                current, digest = key, hashlib.sha256(told.encode())
            yield _digest_rows(done)
        if current:
            yield _digest_rows([(*current, digest.hexdigest())])

    ranged = ended.repartition(*_PREFIX).sortWithinPartitions(*_PREFIX, "conv")
    return ranged.mapInArrow(run, "depth bigint, a bigint, b bigint, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = zip(*rows) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*_PREFIX, "ends_sha256"])


def prefix_trie(
    table: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    segment: int = SEGMENT,
    block: int = BLOCK,
) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    Columns, all bigint but the last: `conv_id` (least member), `depth`,
    `parent_conv_id` (null for the root), `n_convs`, `n_children`, `n_leaves`,
    `saved_tokens`, `ends_sha256`.

    Conversation c is rebuilt from the first h = crc32(c) mod 4 turns of
    conversation c - c % 20, as many as there are, and its own turns after its
    first h. Turns are in order of `turn`, null first; equal turns in order of
    role and then of a digest of role and text, so repeated rows are turns of
    their own. Null roles and texts are empty, rows without a conversation id take
    no part, an empty table gives an empty result, other columns are left out. A
    conversation left without turns belongs to the root alone. Texts and
    conversations may have any length: only digests of 128 bits go on.
    """
    turns = number_turns(table, conv, turn, role, text)
    convs, rebuilt = rebuild(turns)
    linked = with_sums(sorted_neighbours(segments(convs, rebuilt, segment), segment), segment)
    linked = materialize(linked, "linked")
    discard(turns, convs)

    def extents(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return block_nodes(rows, segment)

    blocks = linked.select(
        "part", (F.col("row") / block).cast("bigint").alias("block"), "row", "r", "ka", "kb", "conv", "turns", "left", "own",
        "surplus", "leaves",
    )
    names = "depth a b parent_a parent_b n_convs conv_id saved_tokens n_leaves".split()
    parts = blocks.groupBy("part", "block").applyInArrow(extents, ", ".join(f"{c} bigint" for c in names))
    nodes = parts.groupBy(*_PREFIX).agg(
        F.max("parent_a").alias("parent_a"), F.max("parent_b").alias("parent_b"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "saved_tokens", "n_leaves")],
    )
    nodes = materialize(nodes, "nodes")
    ends = materialize(_end_digests(linked, segment), "ends")
    discard(linked)
    above = ["up_depth", "up_a", "up_b"]
    nodes = nodes.withColumnsRenamed({"parent_a": "up_a", "parent_b": "up_b"}).withColumn("up_depth", F.col("depth") - 1)
    parents = nodes.select(*[F.col(p).alias(u) for p, u in zip(_PREFIX, above)], F.col("conv_id").alias("parent_conv_id"))
    children = nodes.filter("depth > 0").groupBy(*[F.col(u).alias(p) for p, u in zip(_PREFIX, above)])
    children = children.agg(F.count("*").alias("n_children"))
    found = nodes.join(children, _PREFIX, "left").join(ends, _PREFIX, "left").join(parents, above, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
