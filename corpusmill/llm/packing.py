"""Packing documents into batches by optimal length buckets.

All documents of a batch are padded to the bound of their bucket. The bounds are
chosen by dynamic programming over the global histogram of lengths, so that the
padding in all is least for the number of buckets. Inside a bucket, documents in
a seeded random order fill batches whose padded size keeps to a token budget.

The histogram has one bin per length up to 4095 and bins of 12 leading bits
above, so it has a bounded size whatever the table's; each bin's longest length
is known exactly. Bounds are sought among these, so beyond 4095 tokens a bound may
be one part in 2048 above the best one. Documents of equal id and length are
counted first and numbered in pieces of bounded size; pieces are numbered within
their bucket by two steps, first within small random groups and then by the
groups' sizes. So neither an id nor a bucket that holds most documents meets in
one task.
"""

from __future__ import annotations

from collections import deque

from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm import bpe
from corpusmill.runtime import materialize

BUCKETS = 16
BUDGET = 16_384
ROWS_A_GROUP = 4096
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def _bin(length: Column) -> Column:
    """The length with all but its 12 leading bits cleared."""
    shift = F.greatest(F.lit(0), F.length(F.bin(length)) - 12)
    return F.call_function("shiftleft", F.call_function("shiftright", length, shift), shift)


def best_bounds(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Bounds of at most `buckets` buckets with the least padding.

    `histogram` has (longest length, count) of each bin in ascending order. With
    C(i) documents in the first i bins, cost(j) = min over i of cost'(i) + bound(j)
    (C(j) - C(i)): for each bucket more, the least of straight lines in bound(j),
    kept as a convex hull. Exact in whole numbers.
    """
    n = len(histogram)
    if not n:
        return []
    total = [0]
    for _, count in histogram:
        total.append(total[-1] + count)
    infinite = (histogram[-1][0] + 1) * (total[-1] + 1)
    cost, cuts = [0] + [infinite] * n, []
    for _ in range(min(buckets, n)):
        hull: deque[tuple[int, int, int]] = deque()  # slope, height, bin
        fresh, cut = [0] + [infinite] * n, [0] * (n + 1)
        for j in range(1, n + 1):
            line = (-total[j - 1], cost[j - 1], j - 1)
            while len(hull) > 1 and (line[1] - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (
                hull[-1][1] - hull[-2][1]
            ) * (hull[-2][0] - line[0]):
                hull.pop()
            hull.append(line)
            bound = histogram[j - 1][0]
            while len(hull) > 1 and hull[1][0] * bound + hull[1][1] <= hull[0][0] * bound + hull[0][1]:
                hull.popleft()
            slope, height, cut[j] = hull[0]
            fresh[j] = slope * bound + height + bound * total[j]
        cost = fresh
        cuts.append(cut)
    bounds, j = [], n
    for cut in reversed(cuts):
        if j:
            bounds.append(histogram[j - 1][0])
            j = cut[j]
    return bounds[::-1]


def pack(
    lengths: DataFrame,
    key: str = "doc_id",
    length: str = "n_tokens",
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """One row per row of `lengths`: key, `n_tokens`, `bucket`, `padded_to`, `batch`, `slot`.

    Buckets are numbered from the shortest, batches within a bucket, slots within
    a batch, all from 0. A batch holds as many documents as the budget allows at
    the bucket's bound, one at least: a document longer than the budget is whole
    and alone. A null or negative length counts as 0 and such documents lie in
    the first bucket. Repeated rows take a slot each; an empty table gives an
    empty result. The order is a seeded random one and does not depend on
    partitioning.
    """
    size = F.greatest(F.coalesce(F.col(f"`{length}`"), F.lit(0)), F.lit(0)).cast("bigint")
    rows = lengths.select(F.col(f"`{key}`").alias("__key"), size.alias("n_tokens"))
    rows = materialize(rows.groupBy("__key", "n_tokens").agg(F.count("*").alias("__copies")), "lengths")
    counted = rows.groupBy(_bin(F.col("n_tokens"))).agg(F.max("n_tokens").alias("top"), F.sum("__copies").alias("n"))
    bins = sorted((row["top"], row["n"]) for row in counted.collect())
    bounds = best_bounds(bins, buckets)
    if not bounds:
        bounds = [0]
    sizes = [0] * len(bounds)
    for top, n in bins:
        sizes[next(i for i, bound in enumerate(bounds) if top <= bound)] += n
    own, groups, per_batch = (F.lit(None) for _ in range(3))
    for i in reversed(range(len(bounds))):
        fits = F.col("n_tokens") <= bounds[i]
        own = F.when(fits, i).otherwise(own)
        groups = F.when(fits, max(1, -(-sizes[i] // ROWS_A_GROUP))).otherwise(groups)
        per_batch = F.when(fits, max(1, budget // max(1, bounds[i]))).otherwise(per_batch)
    piece = F.explode(F.sequence(F.lit(0), F.floor((F.col("__copies") - 1) / ROWS_A_GROUP)))
    rows = rows.select("*", piece.alias("__piece"), own.cast("int").alias("bucket"), per_batch.cast("bigint").alias("__per_batch"))
    order = F.xxhash64("__key", "n_tokens", "__piece", F.lit(11))
    rows = rows.select(
        "*",
        F.least(F.lit(ROWS_A_GROUP), F.col("__copies") - F.col("__piece") * ROWS_A_GROUP).alias("__size"),
        order.alias("__order"),
        F.pmod(F.shiftrightunsigned(order, 20), groups).cast("int").alias("__group"),
    )
    before = Window.partitionBy("bucket").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("bucket", "__group").agg(F.sum("__size").alias("__n"))
    offsets = offsets.select(
        F.col("bucket").alias("__bucket"),
        F.col("__group").alias("__own"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
    )
    inside = Window.partitionBy("bucket", "__group").orderBy("__order", "__key", "n_tokens", "__piece")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__rank", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
    at_group = (F.col("bucket") == F.col("__bucket")) & (F.col("__group") == F.col("__own"))
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__size") - 1)).alias("__copy")
    rows = rows.join(offsets, at_group).select("*", copy)
    rows = rows.withColumn("__place", F.col("__before") + F.col("__rank") + F.col("__copy"))
    padded = F.element_at(F.from_json(F.lit(str(bounds)), "array<bigint>"), F.col("bucket") + 1)
    return rows.select(
        F.col("__key").alias(key),
        "n_tokens",
        "bucket",
        padded.alias("padded_to"),
        F.floor(F.col("__place") / F.col("__per_batch")).cast("bigint").alias("batch"),
        (F.col("__place") % F.col("__per_batch")).cast("int").alias("slot"),
    )


def pack_texts(
    table: DataFrame,
    vocabulary: Broadcast[bpe.Vocabulary] | None = None,
    key: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """`pack` by the tokens of whole texts, or by their words without a vocabulary; a null text has none."""
    if vocabulary is not None:
        counted = bpe.token_counts(table, vocabulary, key, text)
    else:
        words = word_count(F.col(f"`{text}`").cast("string")).alias("n_tokens")
        counted = table.select(F.col(f"`{key}`").alias(key), words)
    return pack(counted, key, "n_tokens", buckets, budget)
