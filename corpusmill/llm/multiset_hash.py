"""Document fingerprints by a homomorphic multiset hash (native).

Each paragraph (a line that is not empty) is hashed to a wide vector of `LANES`
small centred numbers, drawn from its SHA-256 digest. A text's fingerprint is
the sum of its paragraphs' vectors, each lane modulo `MODULUS`. So the order of
paragraphs does not matter, equal multisets of paragraphs have equal
fingerprints, and a paragraph is inserted or deleted by adding or subtracting
its vector, without the rest of the text.

As the lanes are small and random, the squared length of the difference of two
fingerprints estimates how many paragraphs differ; `likeness` turns that into a
number from 0 (nothing shared) to 1 (equal), with an error of about 0.09. Its
estimate holds while a lane's true value is below half the modulus, which takes
some hundred thousand paragraphs in one text to exceed; equality has no such
limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 128
MODULUS = 1 << 16
ROWS_A_BUCKET = 128
MAX_BUCKETS = 1 << 14


def vector(text: Column) -> Column:
    """The fingerprint of a text as `LANES` numbers from 0 to MODULUS - 1; null or empty: zeros."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line != "")
    digests = F.transform(lines, lambda line: F.sha2(line.cast("binary"), 256))
    seeds = F.sequence(F.lit(0), F.lit(LANES // 8 - 1))
    words = F.transform(digests, lambda d: F.transform(seeds, lambda s: F.xxhash64(d, s)))
    # Eight lanes of 8 bits from each 64-bit word, less their middle.
    part = lambda word, i: F.call_function(
        "shiftright", F.get(word, (i / 8).cast("int")), (i % 8 * 8).cast("int")
    ).bitwiseAND(F.lit(255))
    lanes = F.sequence(F.lit(0), F.lit(LANES - 1))
    zero = F.lit(0).cast("bigint")
    # An array of one element, so that the words are hashed once and not for each lane.
    sums = F.transform(
        F.array(words),
        lambda known: F.transform(
            lanes,
            lambda i: F.pmod(
                F.aggregate(known, zero, lambda total, word: total + part(word, i) - 128), F.lit(MODULUS)
            ),
        ),
    )
    return F.get(sums, F.lit(0))


def add(a: Column, b: Column) -> Column:
    """Insert the paragraphs of `b`."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + y, F.lit(MODULUS)))


def subtract(a: Column, b: Column) -> Column:
    """Delete the paragraphs of `b`."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y, F.lit(MODULUS)))


def _square(a: Column) -> Column:
    half = MODULUS // 2
    centred = F.transform(a, lambda x: (F.pmod(x + half, F.lit(MODULUS)) - half).cast("double"))
    return F.aggregate(centred, F.lit(0.0), lambda total, x: total + x * x)


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1; 1 for equal fingerprints, null when one is null."""
    both = _square(a) + _square(b)
    rest = F.greatest(F.lit(0.0), 1 - _square(subtract(a, b)) / both)
    return F.when(a == b, 1.0).when(a.isNotNull() & b.isNotNull(), rest)


def as_text(a: Column) -> Column:
    """Four hexadecimal digits for each lane."""
    return F.array_join(F.transform(a, lambda x: F.lower(F.lpad(F.hex(x), 4, "0"))), "")


def _bucket(table: DataFrame, rows_a_bucket: int) -> Column:
    """The range of ids in which a row's id lies, of ranges with about as many rows each.

    At most MAX_BUCKETS ranges; their limits are approximate quantiles of all
    ids, a constant of the plan, found by binary search.
    """
    n = max(1, min(MAX_BUCKETS, table.count() // rows_a_bucket))
    steps = [1 << i for i in reversed(range(max(1, n.bit_length())))]
    cuts = table.approxQuantile("__id", [i / (n + 1) for i in range(1, n + 1)], 0.25 / n)
    limits = F.from_json(F.lit(str(sorted({int(cut) for cut in cuts}))), "array<bigint>")
    below = F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda at, step: F.when(F.get(limits, at + step - 1) < F.col("__id"), at + step).otherwise(at),
    )
    return F.when(F.col("__id").isNull(), -1).otherwise(below)


def _heads(dealt: DataFrame) -> DataFrame:
    """The first id of each bucket and the bucket before it, whose guest it is."""
    order = Window.orderBy(F.col("__bucket").desc())  # over MAX_BUCKETS rows at most
    last = F.min("__bucket").over(Window.partitionBy())
    heads = dealt.groupBy("__bucket").agg(F.max("__id").alias("__head"))
    before = F.coalesce(F.lag("__bucket").over(order), last)
    return heads.select(F.col("__bucket").alias("__own"), "__head", before.alias("__host"))


def with_next(
    table: DataFrame, key: str = "doc_id", text: str = "text", rows_a_bucket: int = ROWS_A_BUCKET
) -> DataFrame:
    """Rows in buckets in descending order of the key, each with the next row's text.

    The first row follows the last. Rows are dealt once, by ranges of the key;
    the head of each range is also a guest of the range before it, so that no
    row's successor lies elsewhere. Rows of equal keys follow by text, rows
    without a key come last.
    """
    rows = table.select(
        F.col(f"`{key}`").cast("bigint").alias("__id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"),
    )
    dealt = rows.withColumn("__bucket", _bucket(rows.select("__id"), rows_a_bucket))
    known = F.broadcast(_heads(dealt.select("__bucket", "__id")))
    at_head = (F.col("__bucket") == F.col("__own")) & F.col("__id").eqNullSafe(F.col("__head"))
    places = F.array(
        F.struct(F.col("__bucket"), F.lit(False).alias("__guest")),
        F.when(F.col("__own").isNotNull(), F.struct(F.col("__host").alias("__bucket"), F.lit(True).alias("__guest"))),
    )
    dealt = dealt.join(known, at_head, "left").select("__id", "__text", F.explode(places).alias("__place"))
    dealt = dealt.filter("__place is not null").select("__place.*", "__id", "__text")
    order = Window.partitionBy("__bucket").orderBy("__guest", F.col("__id").desc_nulls_last(), "__text")
    return dealt.select(
        "*", F.lead("__text").over(order).alias("__next"), F.row_number().over(order).alias("__row")
    )


def fingerprint_edits(
    table: DataFrame, key: str = "doc_id", text: str = "text", rows_a_bucket: int = ROWS_A_BUCKET
) -> DataFrame:
    """Fingerprints of every text and of an edited text, and their likeness.

    The edited text has its last floor(n / 3) code points replaced by the first
    as many (or all) of the next text in descending order of the key. Only the
    paragraphs after the last line break before the cut are hashed anew.

    A null text is an empty one; its fingerprint is all zeros. Repeated rows
    give a row each and are one another's successor; an empty table gives an
    empty result; a single row follows itself.
    """
    rows = with_next(table, key, text, rows_a_bucket)
    rows = rows.withColumn("__kept", F.expr("left(__text, length(__text) - length(__text) div 3)"))
    rows = rows.withColumn("__last", F.substring_index("__kept", "\n", -1))
    rows = rows.select(
        "__bucket",
        "__guest",
        "__id",
        "__row",
        F.length("__text").cast("bigint").alias("n_chars"),
        F.expr("left(__kept, length(__kept) - length(__last))").alias("__start"),
        F.expr("substring(__text, length(__kept) - length(__last) + 1)").alias("__old"),
        F.expr("concat(__last, left(coalesce(__next, ''), length(__text) - length(__kept)))").alias("__new"),
    )
    rows = rows.select(
        "__bucket",
        "__guest",
        "__id",
        "__row",
        "n_chars",
        F.sha2(F.concat("__start", "__new").cast("binary"), 256).alias("edited_sha256"),
        vector(F.col("__start")).alias("__same"),
        vector(F.col("__old")).alias("__less"),
        vector(F.col("__new")).alias("__more"),
    )
    rows = rows.withColumn("__full", add(F.col("__same"), F.col("__less")))
    rows = rows.withColumn("__edited", add(subtract(F.col("__full"), F.col("__less")), F.col("__more")))
    order = Window.partitionBy("__bucket").orderBy("__row")
    rows = rows.withColumn("__after", F.lead("__full").over(order)).filter("not __guest")
    return rows.select(
        F.col("__id").alias(key),
        "n_chars",
        "edited_sha256",
        as_text(F.col("__full")).alias("fingerprint"),
        as_text(F.col("__edited")).alias("edited_fingerprint"),
        likeness(F.col("__full"), F.col("__edited")).alias("near_edited"),
        likeness(F.col("__full"), F.col("__after")).alias("near_next"),
    )
