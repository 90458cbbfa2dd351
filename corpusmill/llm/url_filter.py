"""URL rules by a Bloom filter cascade (native).

Rules are (host, path) prefixes. Every URL gives a few candidate keys: the ends
of its host by whole labels, each with the starts of its path, for just the
shapes (labels, path length) that occur in the list. A cascade tells for every
candidate key whether it is listed:

* level 0 encodes the listed keys that the corpus holds,
* level 1 the false positives of level 0 over the whole key universe,
* level 2 the listed keys that level 1 wrongly holds, and so on,

until a level has no false positive. The first level that lacks a key decides,
so membership is exact for the universe the cascade was built on, and a lookup
is a few tests of bits with no join. Building it moves only the keys that pass
level 0, reduced to distinct keys before the shuffle.

A filter is one array of at most `MAX_KEYS` keys' bits (about 8 MB), read by a
scalar subquery. Longer lists are dealt into blocks by hash, each with a cascade
of its own and one pass over the URLs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.runtime import materialize

MAX_KEYS = 1 << 22
BITS_PER_KEY = 16
PROBES = 6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(url, _PARTS, 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty where there is no `://`."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """(rule, action) from ("host/path", "block" or "allow")."""
    return spark.createDataFrame(list(rules), "rule string, action string")


def _bit(key: Column, seed: int, probe: int, size: int) -> Column:
    low = F.xxhash64(key, F.lit(2 * seed)).bitwiseAND(F.lit(0x7FFFFFFF))
    step = F.xxhash64(key, F.lit(2 * seed + 1)).bitwiseAND(F.lit(0x7FFFFFFF)).bitwiseOR(F.lit(1))
    return F.pmod(low + step * F.lit(probe), F.lit(size))


class Level:
    """One Bloom filter: an array of 64-bit words, read through a scalar subquery."""

    def __init__(self, keys: DataFrame, n: int, seed: int) -> None:
        self.seed = seed
        self.words = max(1, math.ceil(n * BITS_PER_KEY / 64))
        bits = F.array(*[_bit(F.col("__key"), seed, i, self.words * 64) for i in range(PROBES)])
        packed = (
            keys.select(F.explode(bits).alias("__bit"))
            .groupBy(F.expr("cast(__bit div 64 as int)").alias("__word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(__bit % 64 as int)))").alias("__bits"))
        )
        # Words without a bit are zeros, so the sorted list has a word at each place.
        every = keys.sparkSession.range(self.words).selectExpr("cast(id as int) as __word", "0L as __bits")
        filled = packed.unionByName(every).groupBy("__word").agg(F.expr("bit_or(__bits)").alias("__bits"))
        words = F.expr("transform(array_sort(collect_list(struct(__word, __bits))), x -> x.__bits)")
        table = materialize(filled.agg(words.alias("__words")), "filter")
        self.array = table.scalar()

    def holds(self, key: Column) -> Column:
        tests = []
        for probe in range(PROBES):
            bit = _bit(key, self.seed, probe, self.words * 64)
            word = F.get(self.array, F.shiftright(bit, 6).cast("int"))
            inside = F.call_function("shiftright", word, F.pmod(bit, F.lit(64)).cast("int"))
            tests.append(inside.bitwiseAND(F.lit(1)) == 1)
        return reduce(lambda a, b: a & b, tests)


class Cascade:
    """Exact membership in a list for every key of one universe."""

    def __init__(self, universe: DataFrame, listed: DataFrame) -> None:
        """Both have one column `__key`; repeated keys are fine."""
        self.levels: list[Level] = []
        n = listed.count()
        if not n:
            return
        self.levels.append(Level(listed, n, 0))
        passed = universe.filter(self.levels[0].holds(F.col("__key"))).distinct()
        marked = passed.join(listed.distinct().withColumn("__listed", F.lit(True)), "__key", "left")
        marked = materialize(marked, "passed")
        inside = marked.filter("__listed").select("__key")
        wrong = marked.filter("__listed is null").select("__key")
        while (n := wrong.count()) > 0:
            level = Level(wrong, n, len(self.levels))
            self.levels.append(level)
            inside, wrong = wrong, inside.filter(level.holds(F.col("__key")))

    def contains(self, key: Column) -> Column:
        """The first level that lacks the key decides; even levels hold listed keys."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for depth in reversed(range(len(self.levels))):
            answer = F.when(self.levels[depth].holds(key), answer).otherwise(depth % 2 == 1)
        return answer


class BlockedCascade:
    """A cascade for each hash block of a list of any length."""

    def __init__(self, universe: DataFrame, listed: DataFrame, max_keys: int) -> None:
        self.n = max(1, math.ceil(listed.count() / max_keys))
        own = self._block(F.col("__key"))
        self.parts = [Cascade(universe.filter(own == i), listed.filter(own == i)) for i in range(self.n)]

    def _block(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(self.n))

    def contains(self, key: Column) -> Column:
        if self.n == 1:
            return self.parts[0].contains(key)
        own = [(self._block(key) == i) & part.contains(key) for i, part in enumerate(self.parts)]
        return reduce(lambda a, b: a | b, own)


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    max_keys: int = MAX_KEYS,
) -> DataFrame:
    """`pages` with `host`, `path`, `rule` and `verdict`; columns of these names are replaced.

    A rule `host/path` fits its host and all subdomains where the path starts
    with the rule's. The longest rule wins, of equally long ones the one with
    more host labels; a rule listed with both actions blocks. A URL that no rule
    fits (also a null, empty or malformed one) has a null rule and the verdict
    `default`: its keys are in no list. Rules that are null or have another
    action are ignored; an empty list gives every page the default. Repeated
    pages are judged alike, an empty table gives an empty result. URLs are read
    whole, whatever their length; other columns may have any name.
    """
    own = "__"
    while any(c.lower().startswith(own) for c in pages.columns):
        own += "_"
    listed = (
        rules.filter(F.col("rule").isNotNull() & F.col("action").isin("block", "allow"))
        .select(
            F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER).alias("__host"),
            F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("__path"),
            "action",
        )
        .withColumn("__key", F.concat("__host", "__path"))
    )
    # As many shapes as forms of rules, whatever their number.
    shape = listed.select(F.size(F.split("__host", "[.]")), F.length("__path")).distinct()
    shapes = sorted(tuple(row) for row in shape.collect())
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    parts = [host(F.col(f"`{url}`")).alias("host"), path(F.col(f"`{url}`")).alias("path")]
    judged = pages.select(*kept, *parts)
    if not shapes:
        return judged.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = [
        F.when(
            (F.size(F.split("host", "[.]")) >= labels) & (F.length("path") >= chars),
            F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, chars)),
        )
        for labels, chars in shapes
    ]
    universe = pages.select(*parts).select(F.explode(F.array(*keys)).alias("__key"))
    universe = universe.filter("__key is not null")
    cascades = {
        action: BlockedCascade(
            universe, listed.filter(F.col("action") == action).select("__key").distinct(), max_keys
        )
        for action in ("allow", "block")
    }
    names, chosen = [f"{own}key{i}" for i in range(len(keys))], own + "best"
    judged = judged.withColumns(dict(zip(names, keys, strict=True)))
    fits = [
        F.when(
            cascades[action].contains(F.col(name)),
            F.struct(
                F.length(name).alias("n"),
                F.lit(labels).alias("labels"),
                F.lit(action == "block").alias("blocks"),
                F.col(name).alias("rule"),
            ),
        )
        for name, (labels, _) in zip(names, shapes, strict=True)
        for action in cascades
    ]
    best = F.array_max(F.array(*fits))
    verdict = F.when(F.col(f"{chosen}.blocks"), "block").otherwise("allow")
    return judged.withColumn(chosen, best).select(
        *kept,
        "host",
        "path",
        F.col(f"{chosen}.rule").alias("rule"),
        F.when(F.col(chosen).isNull(), default).otherwise(verdict).alias("verdict"),
    )
