"""Leak-free split: all rows of a source go to the same split.

Sources are put in the order of md5(seed | key). The first 80% of them are
train, the next 10% val, the rest test, counted exactly. Two boundary keys
describe such a split completely, so once they are known every row finds its
split by comparing its own hash: no join, and a source holding a third of all
rows costs no more than any other.

Sources whose pairs are near-copies of each other can be kept together: then the
connected components of sources and band buckets are what is drawn and counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill import fixed_values as fv
from corpusmill.functions.minhash import band_keys, each_band_key, signature
from corpusmill.operators.components import components
from corpusmill.operators.dedupe import HOT_ROWS, leader_links, long_enough
from corpusmill.operators.pairs import pair_key
from corpusmill.runtime import materialize

# Band keys of a pair's text, null where it is not worth signing.
BANDED = "__pair_bands"
# 16^4 histogram bins: a fixed size however many keys there are.
_BIN_CHARS = 4


def split_key() -> Column:
    """The source path; a pair without one is its own group."""
    own = F.concat(F.lit("seed::"), F.col("task_type"), F.lit("::"), pair_key())
    return F.coalesce(F.nullif(F.col("source_path"), F.lit("")), own)


def _draw(seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("split_key")))


def _place() -> Column:
    """`draw` has a fixed width, so this one string orders by (draw, split_key)."""
    return F.concat("draw", "split_key")


def split_keys(pairs: DataFrame, seed: int = fv.SEED) -> DataFrame:
    """Distinct keys and their place in the seeded order."""
    return (
        pairs.select(split_key().alias("split_key"))
        .distinct()
        .withColumn("draw", _draw(seed))
    )


def cut_points(keys: DataFrame) -> DataFrame:
    """One row: the places of the first val key and of the first test key, or null.

    A histogram over the hash prefix tells in which bin each cut lies; only the
    keys of those two bins are ranked.
    """
    bins = keys.groupBy(F.substring("draw", 1, _BIN_CHARS).alias("bin")).agg(
        F.count("*").alias("in_bin")
    )
    # Unpartitioned windows, but over at most 65,536 bins.
    running = bins.select(
        "bin",
        (F.sum("in_bin").over(Window.orderBy("bin")) - F.col("in_bin")).alias("before"),
        "in_bin",
        F.sum("in_bin").over(Window.partitionBy()).alias("n"),
    )
    n = F.col("n")
    n_train = F.greatest(F.lit(1), F.floor(n * F.lit(fv.TRAIN_SHARE)))
    n_val = F.when(n > 2, F.greatest(F.lit(1), F.floor(n * F.lit(fv.VAL_SHARE)))).otherwise(0)
    cuts = running.select(
        "bin",
        "before",
        "in_bin",
        F.explode(F.create_map(F.lit("val"), n_train, F.lit("test"), n_train + n_val)).alias(
            "split", "rank"
        ),
    ).filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("in_bin")))
    ranked = (
        keys.withColumn("bin", F.substring("draw", 1, _BIN_CHARS))
        .join(F.broadcast(cuts), "bin")  # two rows at most
        .withColumn(
            "place",
            F.row_number().over(Window.partitionBy("split").orderBy("draw", "split_key"))
            + F.col("before")
            - 1,
        )
        .filter("place = rank")
    )
    return ranked.agg(
        F.max(F.when(F.col("split") == "val", _place())).alias("val"),
        F.max(F.when(F.col("split") == "test", _place())).alias("test"),
    )


def split_of(keys: DataFrame) -> Column:
    """The split of a row holding `draw` and `split_key`, given all keys.

    The one-row result of `cut_points` is read here, so that rows are compared
    with two constants however often the column is used.
    """
    cuts = cut_points(keys).first()

    def before(cut: str) -> Column:
        return F.lit(True) if cuts[cut] is None else _place() < F.lit(cuts[cut])

    return F.when(before("val"), "train").when(before("test"), "val").otherwise("test")


def split_assign(keys: DataFrame) -> DataFrame:
    """(split_key, split) for every key."""
    return keys.select("split_key", split_of(keys).alias("split"))


def split_rows(pairs: DataFrame, seed: int = fv.SEED) -> DataFrame:
    """Pairs with their `split_key` and `split`."""
    keys = split_keys(pairs, seed)
    return (
        pairs.withColumn("split_key", split_key())
        .withColumn("draw", _draw(seed))
        .withColumn("split", split_of(keys))
        .drop("draw")
    )


def _pair_text() -> Column:
    return F.concat_ws("\n", "input", "output")


def with_bands(pairs: DataFrame, text: Column | None = None) -> DataFrame:
    """Pairs, written with the band keys of their text, so that several steps sign them only once.

    Steps that get these pairs use the keys in place of their `text`.
    """
    told = _pair_text() if text is None else text
    worth = F.length(told) >= fv.MIN_RECORD_CHARS
    return materialize(pairs.withColumn(BANDED, F.when(worth, band_keys(signature(told)))), "banded-pairs")


def _banded(pairs: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, bands) of all pairs whose text is worth signing."""
    if BANDED in pairs.columns:
        return pairs.select(key, F.col(BANDED).alias("bands")).filter("bands is not null")
    told = long_enough(pairs.select(key, text.alias("content")))
    return told.select(key, band_keys(signature(F.col("content"))).alias("bands"))


def _bucketed(pairs: DataFrame, text: Column) -> DataFrame:
    """(split_key, bucket) of all pairs whose text is worth signing."""
    bands = _banded(pairs.withColumn("split_key", split_key()), "split_key", text).distinct()
    return materialize(bands, "pair-bands").select("split_key", F.explode(each_band_key(F.col("bands"))).alias("bucket"))


def near_groups(pairs: DataFrame, text: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(split_key, split_group): keys whose pairs share a band bucket, directly or by others, share a group.

    A group is named by its least key. `text` is what is compared, by default
    input and output of a pair.
    """
    told = _pair_text() if text is None else text
    keys = pairs.select(split_key().alias("split_key")).distinct()
    keys = materialize(keys.withColumn("id", F.monotonically_increasing_id()), "split-keys")
    members = _bucketed(pairs, told).join(keys, "split_key").select(F.col("id").alias("__ord"), "bucket").distinct()
    links = leader_links(materialize(members, "split-buckets"), hot_rows)
    roots = components(links, "leader", "__ord")
    rooted = keys.join(roots, keys["id"] == roots["node"], "left")
    rooted = materialize(rooted.select("split_key", F.coalesce("root", "id").alias("root")), "split-roots")
    names = rooted.groupBy("root").agg(F.min("split_key").alias("split_group"))
    return rooted.join(names, "root").select("split_key", "split_group")


def near_split_assign(
    pairs: DataFrame, seed: int = fv.SEED, text: Column | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(split_key, split_group, split) for every key: the cuts of `split_assign`, over groups."""
    groups = materialize(near_groups(pairs, text, hot_rows), "split-groups")
    named = groups.withColumnsRenamed({"split_key": "own_key", "split_group": "split_key"}).withColumn("draw", _draw(seed))
    split = split_of(named.select("split_key", "draw").distinct())
    return named.select(F.col("own_key").alias("split_key"), F.col("split_key").alias("split_group"), split.alias("split"))


def near_split_rows(pairs: DataFrame, seed: int = fv.SEED, text: Column | None = None) -> DataFrame:
    """Pairs with `split_key`, `split_group` and `split`; no two near pairs are in different splits."""
    assigned = near_split_assign(pairs, seed, text)
    return pairs.withColumn("split_key", split_key()).join(assigned, "split_key")


def near_leak_check(rows: DataFrame, text: Column | None = None) -> DataFrame:
    """Band buckets of split pairs, and buckets found in more than one split (zero after `near_split_rows`)."""
    told = _pair_text() if text is None else text
    bands = _banded(rows, "split", told).select("split", F.explode(each_band_key(F.col("bands"))).alias("bucket"))
    per_bucket = bands.groupBy("bucket").agg(F.min("split").alias("lo"), F.max("split").alias("hi"))
    return per_bucket.agg(
        F.count("*").alias("n_buckets"), F.count_if(F.col("lo") != F.col("hi")).alias("n_leaking")
    )


def split_stats(rows: DataFrame) -> DataFrame:
    """Rows per split, zero included, with a warning where val or test is empty."""
    counts = rows.groupBy("split").agg(F.count("*").alias("n_rows"))
    names = rows.sparkSession.createDataFrame([(s,) for s in fv.SPLITS], "split string")
    n = F.coalesce("n_rows", F.lit(0)).cast("bigint")
    return names.join(counts, "split", "left").select(
        "split", n.alias("n_rows"), ((n == 0) & (F.col("split") != "train")).alias("warn_empty")
    )


def split_leak_check(rows: DataFrame) -> DataFrame:
    """Keys, and keys found in more than one split (must be zero)."""
    per_key = rows.groupBy("split_key").agg(F.min("split").alias("lo"), F.max("split").alias("hi"))
    return per_key.agg(
        F.count("*").alias("n_keys"), F.count_if(F.col("lo") != F.col("hi")).alias("n_leaking")
    )
