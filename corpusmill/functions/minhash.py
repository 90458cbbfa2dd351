"""MinHash signatures of 5-character shingles, and their band keys, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from corpusmill.fixed_values import BAND_ROWS, BANDS, SHINGLE_CHARS
from corpusmill.functions import sketch
from corpusmill.functions.text import normalize

# An empty match at every position that captures the five characters after it.
# The first look-ahead skips the middle of a surrogate pair.
_EACH_SHINGLE = rf"(?s)(?![\x{{DC00}}-\x{{DFFF}}])(?=(.{{{SHINGLE_CHARS}}}))"

_signature = F.arrow_udf(sketch.signatures, ArrayType(IntegerType()))


def signature(text: Column) -> Column:
    """array<int> of 128; a text without shingles gets the constant EMPTY array."""
    return _signature(text)


def band_keys(sig: Column) -> Column:
    """The 8 band keys, 16 bytes each, in one binary value."""
    return F.concat(*[F.unhex(band_key_hex(sig, band)) for band in range(BANDS)])


def each_band_key(keys: Column) -> Column:
    """array<binary> of the 8 keys in the result of `band_keys`."""
    return F.array(*[F.substring(keys, 16 * band + 1, 16) for band in range(BANDS)])


def band_key_hex(sig: Column, band: int) -> Column:
    """md5 of the band number and the band's 16 values."""
    rows = F.slice(sig, band * BAND_ROWS + 1, BAND_ROWS).cast("array<string>")
    return F.md5(F.concat(F.lit(f"{band}|"), F.concat_ws(",", rows)))


def shingles(text: Column) -> Column:
    """Distinct shingles of the normalised text; empty below five characters."""
    return F.array_distinct(F.regexp_extract_all(normalize(text), F.lit(_EACH_SHINGLE), 1))
