"""Removal of repeated passages by recompression.

Each text is a string of words. Rounds of recompression replace runs of equal
symbols and pairs of neighbours by new symbols: a round deals all symbols to two
sides by a bit of their name and merges each left symbol with a right one after
it. A name is a 64-bit digest of what it stands for, so it is the same in all
texts and tasks without any exchange, and equal substrings get equal symbols but
near their ends.

How near is known: every symbol carries its context, the words that decide that
it exists. A symbol whose context lies within a window of `WINDOW` words is there
wherever the window's words are. So each window is served by the leftmost symbol
of the highest level with its context inside; equal windows have equal anchors.

1. One pass over the texts gives each text's anchors and the windows they serve.
2. Anchors that occur in one text only rule their windows out.
3. The other windows are verified: two 64-bit digests of their words, and the
   least document that holds each.
4. Words covered by a window that a smaller document holds are removed.

Texts of the same words are one class from the start: only its smallest document
is looked at, the others are copies as a whole. Hot symbols and windows meet only
sums that are combined before the shuffle, and joins with one row per key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm import words
from corpusmill.runtime import discard, materialize

WINDOW = 50
ROUNDS = 12
RUN_ROUNDS = 3  # later symbols are long, and a run's end would widen each context too far
_LAST = (1 << 63) - 1  # stands for a null key: after all others


class _Parse:
    """The symbols of a slice at one level."""

    def __init__(self, name, owner, first, low, high) -> None:
        self.name = name  # of each symbol
        self.owner = owner  # its text
        self.first = first  # its first word
        self.low, self.high = low, high  # its context: words from low to before high

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether the symbol before, and after, belongs to the same text."""
        same = self.owner[1:] == self.owner[:-1]
        return np.append(False, same), np.append(same, False)

    def _reach(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contexts widened to the neighbour before where `left`, and after where `right`."""
        low, high = self.low.copy(), self.high.copy()
        low[1:] = np.where(left[1:], np.minimum(low[1:], self.low[:-1]), low[1:])
        high[:-1] = np.where(right[:-1], np.maximum(high[:-1], self.high[1:]), high[:-1])
        return low, high

    def runs(self, level: int) -> _Parse:
        """Runs of equal symbols named; that a symbol is no longer run is told by its neighbours.

        At a text's end there is no neighbour that could tell, so a window there
        ends before: the context goes one word beyond the text.
        """
        before, after = self._neighbours()
        low, high = self._reach(before, after)
        low, high = np.where(before, low, low - 1), np.where(after, high, high + 1)
        fresh = np.append(True, (self.name[1:] != self.name[:-1]) | (self.owner[1:] != self.owner[:-1]))
        start = np.flatnonzero(fresh)
        length = np.diff(np.append(start, len(self.name)))
        name = self.name[start]
        named = words.mix(name + words.mix(length.astype(np.uint64) + np.uint64(level << 32)))
        last = start + length - 1
        return _Parse(np.where(length > 1, named, name), self.owner[start], self.first[start], low[start], high[last])

    def pairs(self, level: int) -> _Parse:
        """Each left symbol merged with a right one after it."""
        bit = words.mix(self.name + np.uint64(level * 2 + 1)) >> np.uint64(63) == 1
        before, after = self._neighbours()
        merged = ~bit & after
        merged[:-1] &= bit[1:]
        second = np.append(False, merged[:-1])
        # A symbol stays alone as its neighbour on the open side is not of the other side.
        low, high = self._reach(bit & before & ~second, ~bit & after & ~merged)
        low = np.where(bit & ~before, low - 1, low)
        high = np.where(~bit & ~after, high + 1, high)
        at = np.flatnonzero(merged)
        name = self.name.copy()
        name[at] = words.mix(name[at] * np.uint64(3) + words.mix(name[at + 1] + np.uint64(level)))
        low[at], high[at] = self.low[at], self.high[at + 1]
        kept = ~second
        return _Parse(name[kept], self.owner[kept], self.first[kept], low[kept], high[kept])


def levels(hashes: np.ndarray, owner: np.ndarray) -> Iterator[_Parse]:
    """Parses from the words themselves upwards."""
    place = np.arange(len(hashes))
    parse = _Parse(hashes, owner, place, place, place + 1)
    yield parse
    for level in range(1, ROUNDS + 1):
        if level <= RUN_ROUNDS:
            parse = parse.runs(level)
        parse = parse.pairs(level)
        yield parse


def anchors(part: words.Slice, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, name, from, to): each anchor and the windows, by first word, that it serves."""
    owner = part.text_of_word()
    n = len(owner)
    starts = np.arange(n)
    open_ = starts + window <= part.bounds[1:][owner] if n else np.zeros(0, bool)
    todo = starts[open_]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for level, parse in reversed(list(enumerate(levels(part.hashes(), owner)))):
        if not len(todo):
            break
        # Contexts start and end in the order of their symbols.
        at = np.minimum(np.searchsorted(parse.low, todo), len(parse.low) - 1)
        hit = (parse.low[at] >= todo) & (parse.high[at] <= todo + window)
        at = at[hit]
        name = words.mix(parse.name[at] + np.uint64(level << 8))
        found.append((todo[hit], name, parse.first[at]))
        todo = todo[~hit]
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, np.zeros(0, np.uint64), empty, empty
    start, name, place = (np.concatenate(column) for column in zip(*found, strict=True))
    order = np.argsort(start, kind="stable")
    start, name, place = start[order], name[order], place[order]
    # Consecutive windows of one anchor are one row.
    fresh = np.append(True, (name[1:] != name[:-1]) | (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1))[: len(start)]
    begin = np.flatnonzero(fresh)
    end = np.append(begin[1:], len(start)) - 1
    text = owner[start[begin]]
    return text, name[begin], start[begin] - part.bounds[text], start[end] + 1 - part.bounds[text]


def _identified(table: DataFrame, key: str, text: str) -> DataFrame:
    """`table` with `__key` and `__tid`: rows of one key with unlike texts differ in `__tid`."""
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return table.withColumns(
        {
            "__key": F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(_LAST)),
            "__tid": F.xxhash64(content),
            text: content,
        }
    )


def _scan(texts: DataFrame, window: int) -> DataFrame:
    """One row per text: digests of its word sequence, their number, its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second, counts, names, spans = [], [], [], [], []
            for part in words.slices(batch["text"]):
                hashes = part.hashes()
                text, name, begin, end = anchors(part, window)
                cut = np.searchsorted(text, np.arange(part.n_texts + 1))
                packed = begin << 32 | end
                for i in range(part.n_texts):
                    own = hashes[part.bounds[i] : part.bounds[i + 1]]
                    for digests, seed in ((first, 1), (second, 2)):
                        factors = words.multipliers(len(own), seed)[: len(own)]
                        digests.append(int((own * factors).sum(dtype=np.uint64).astype(np.int64)))
                    counts.append(len(own))
                    names.append(name[cut[i] : cut[i + 1]].tobytes())
                    spans.append(packed[cut[i] : cut[i + 1]].astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    batch["tid"],
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.array(counts, pa.int32()),
                    pa.array(names, pa.binary()),
                    pa.array(spans, pa.binary()),
                ],
                ["key", "tid", "h1", "h2", "n", "names", "spans"],
            )

    kinds = "key bigint, tid bigint, h1 bigint, h2 bigint, n int, names binary, spans binary"
    return texts.mapInArrow(run, kinds)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each anchor of a text."""
    for batch in batches:
        names, spans = batch["names"].to_pylist(), batch["spans"].to_pylist()
        ids = np.repeat(batch["h1"].to_numpy(), [len(name) // 8 for name in names])
        columns = [np.frombuffer(b"".join(names), "<i8"), ids, np.frombuffer(b"".join(spans), "<i8")]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["name", "h1", "span"])


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """(k1, k2, key, rid, start): digests of the windows that a text's `spans` list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch["key"].to_numpy(), batch["rid"].to_numpy()
            lists = batch["spans"].to_pylist()
            for part in words.slices(batch["text"]):
                hashes = part.hashes()
                place, text = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for i in range(part.n_texts):
                    spans = np.array(lists[part.first + i], np.int64)
                    spans = spans[(spans & 0xFFFFFFFF) + window - 1 <= part.bounds[i + 1] - part.bounds[i]]
                    begin, count = spans >> 32, (spans & 0xFFFFFFFF) - (spans >> 32)
                    steps = np.arange(count.sum()) + np.repeat(begin - np.cumsum(count) + count, count)
                    place.append(steps + part.bounds[i])
                    text.append(np.full(len(steps), i))
                place, text = np.concatenate(place), np.concatenate(text)
                digests = np.zeros((2, len(place)), np.uint64)
                for seed, digest in enumerate(digests):
                    for j, factor in enumerate(words.multipliers(window, seed + 1)[:window]):
                        digest += hashes[place + j] * factor
                columns = [
                    *words.mix(digests).astype(np.int64),
                    keys[part.first + text],
                    ids[part.first + text],
                    (place - part.bounds[text]).astype(np.int32),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["k1", "k2", "key", "rid", "start"]
                )

    return texts.mapInArrow(run, "k1 bigint, k2 bigint, key bigint, rid bigint, start int")


def repeated_windows(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, tid, whole, starts) of the texts that hold windows of smaller keys.

    `starts` are the first words of these windows; `whole` tells that all words
    go, as a smaller key has the same words.
    """
    scanned = materialize(_scan(texts, window), "anchors")
    known = materialize(scanned.select("key", "tid", "h1", "h2", "n"), "digests")
    classes = known.filter(F.col("n") >= window).groupBy("h1", "h2")
    classes = classes.agg(F.min(F.struct("key", "tid")).alias("least")).select("h1", "h2", "least.*")
    classes = materialize(classes.withColumn("rid", F.monotonically_increasing_id()), "texts")
    # Copies have the same anchors; a class is told by one digest here, and should
    # two ever share it, each gets the other's windows to verify as well.
    rows = scanned.select("h1", "names", "spans").mapInArrow(_unpack, "name bigint, h1 bigint, span bigint")
    shared = rows.groupBy("name").agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
    shared = materialize(shared.filter("a < b").select("name"), "shared")
    discard()
    spans = rows.join(shared, "name", "left_semi").select("h1", "span").distinct()
    spans = spans.groupBy("h1").agg(F.collect_list("span").alias("spans"))
    spans = materialize(classes.select("rid", "key", "tid", "h1").join(spans, "h1").drop("h1"), "spans")
    discard(scanned, shared)
    windows = materialize(_windows(texts.join(spans, ["key", "tid"]), window), "windows")
    discard(spans)
    least = windows.groupBy("k1", "k2").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    least = least.filter("least < most").drop("most")
    later = windows.join(least, ["k1", "k2"]).filter("key > least").select("rid", "start")
    starts = later.groupBy("rid").agg(F.array_distinct(F.collect_list("start")).alias("starts"))
    of_class = classes.withColumnRenamed("key", "least").drop("tid").join(starts, "rid", "left")
    found = known.select("key", "tid", "h1", "h2").join(of_class, ["h1", "h2"])
    whole = F.col("key") > F.col("least")
    found = found.filter(whole | F.col("starts").isNotNull()).select(
        "key", "tid", whole.alias("whole"), F.when(~whole, F.col("starts")).alias("starts")
    )
    found = materialize(found.dropDuplicates(["key", "tid"]), "repeats")
    discard(known, classes, windows)
    return found


def _cut(raw: bytes, gone: np.ndarray, joined: bool) -> bytes:
    """A text without the marked words."""
    if joined:
        return b" ".join(word for word, cut in zip(raw.split(), gone, strict=True) if not cut)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    starts = words.Slice(0, np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), words.WORD_CLASSES).starts
    places = np.append(starts, len(raw))[edges]
    kept = np.concatenate([[0], places, [len(raw)]]).reshape(-1, 2)
    return b"".join(raw[a:b] for a, b in kept)


def remove_repeats(
    table: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, joined: bool = False
) -> DataFrame:
    """`table` with what is left in `text`, and with `n_words` and `n_removed`.

    A word goes if a window of `window` words that covers it also starts in a row
    with a smaller key. Windows are judged on the input. White space between kept
    words stays as it is; with `joined` the kept words are joined by one space.
    Columns `n_words` and `n_removed` of the table are replaced.

    A null text has no words and becomes an empty one. Rows without a key count
    as the last and lose nothing to one another; nor do rows of one key. Texts
    shorter than a window lose nothing. Very long texts and long runs of a word
    are treated as any other. An empty table gives an empty result.
    """
    table = table.drop("n_words", "n_removed")
    rows = _identified(table, key, text)
    found = repeated_windows(rows.select(F.col("__key").alias("key"), F.col("__tid").alias("tid"), F.col(f"`{text}`").alias("text")), window)
    found = found.select(*[F.col(c).alias(f"__{c}") for c in found.columns])
    rows = rows.join(found, ["__key", "__tid"], "left")
    rows = rows.select(*[f"`{c}`" for c in table.columns], "__whole", "__starts")
    names = table.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, left = [], [], []
            columns = (batch[c].to_pylist() for c in ("__whole", "__starts"))
            for content, whole, starts in zip(batch[text].cast(pa.binary()).to_pylist(), *columns, strict=True):
                n = len(content.split())
                total.append(n)
                if whole is None:
                    removed.append(0)
                    left.append(b" ".join(content.split()) if joined else content)
                    continue
                marks = np.zeros(n + 1, np.int32)
                if starts is not None:
                    np.add.at(marks, starts, 1)
                    np.add.at(marks, np.array(starts) + window, -1)
                gone = np.cumsum(marks)[:n] > 0 if not whole else np.ones(n, bool)
                removed.append(int(gone.sum()))
                left.append(_cut(content, gone, joined))
            kept = [batch.column(i) for i in range(len(names))]
            kept[at] = pa.array(left, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
                [*names, "n_words", "n_removed"],
            )

    fields = [T.StructField(f.name, T.StringType() if f.name == text else f.dataType) for f in table.schema]
    fields += [T.StructField(name, T.LongType()) for name in ("n_words", "n_removed")]
    return rows.mapInArrow(run, T.StructType(fields))
