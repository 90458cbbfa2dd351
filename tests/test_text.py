"""Column functions against plain Python on random Unicode text."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import lcs, minhash, rouge, sketch, text
from corpusmill.operators import pairs, prefs

PIECES = list("ab AB=+'!\t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　​Éßİé中😀#`") + [
    "==", "===", "+ 1'b1", "+ 1'b1", "if (!rst_n)", "assert property (x);", "\n", "\n\n",
    "```\n", "```systemverilog\n", "\n```", "lbl: ",
]


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(7)
    rows = [("".join(rng.choices(PIECES, k=rng.randint(0, 25))),) for _ in range(1500)]
    return spark.createDataFrame(rows, "t string").repartition(4).cache()


def pairs_of(samples, column):
    return samples.select("t", column.alias("got")).collect()


def test_strip(samples):
    for t, got in pairs_of(samples, text.strip(F.col("t"))):
        assert got == t.strip()


def test_normalize(samples):
    for t, got in pairs_of(samples, text.normalize(F.col("t"))):
        assert got == " ".join(t.lower().split())


def test_shingles_are_distinct_code_point_windows(samples):
    for t, got in pairs_of(samples, minhash.shingles(F.col("t"))):
        n = " ".join(t.lower().split())
        assert len(got) == len(set(got))
        assert set(got) == {n[i : i + 5] for i in range(len(n) - 4)}


@pytest.mark.parametrize(
    "edit, pattern, new",
    [
        ("flip_comparison", r"==(?!=)", "!="),
        ("off_by_one_increment", r"\+\s*1'b1", "+ 2'b10"),
        ("invert_reset_polarity", r"if\s*\(\s*!rst_n\s*\)", "if (rst_n)"),
    ],
)
def test_inject_first_match_only(samples, edit, pattern, new):
    for t, got in pairs_of(samples, pairs.inject(F.col("t"), edit)):
        found = re.search(pattern, t)
        assert got == (t if not found else t[: found.start()] + new + t[found.end() :])


def test_make_rejected(samples):
    for t, got in pairs_of(samples, prefs.make_rejected(F.col("t"))):
        lines = t.split("\n")
        changed = [
            f"{m[1]}// {m[2]}  (disabled - checks nothing)" if (m := re.fullmatch(r"(\s*)(assert property.*)", line))
            else line
            for line in lines
        ]
        want = "\n".join(changed)
        assert got == (want if want != t else None)


def test_code_blocks(samples):
    for t, got in pairs_of(samples, text.code_blocks(F.col("t"))):
        want, rest = [], t
        while (m := re.search(r"```(systemverilog)?\n", rest)) is not None:
            end = rest.find("\n```", m.end())
            if end < 0:
                # This fence never closes, but a later one may open inside it.
                rest = rest[m.start() + 1 :]
                continue
            want.append(rest[m.end() : end])
            rest = rest[end + 4 :]
        assert got == want


def test_first_only_with_no_dollar_surprise(spark):
    row = spark.range(1).select(text.replace_first(F.lit("a == b == c"), "==(?!=)", "!=")).first()
    assert row[0] == "a != b == c"


def test_quirk_of_triple_equals(spark):
    assert spark.range(1).select(pairs.inject(F.lit("a === b"), "flip_comparison")).first()[0] == "a =!= b"


# ---- signatures -------------------------------------------------------------
def slow_signature(normalized: str) -> list[int]:
    low = [2**32 - 1] * 128
    for i in range(len(normalized) - 4):
        x = 0
        for c in normalized[i : i + 5]:
            x = ((x ^ ord(c)) * sketch.MIX) % 2**32
            x ^= x >> 15
        low = [min(v, a * x % 2**32) for v, a in zip(low, sketch.MULTIPLIERS)]
    return [v >> 1 for v in low]


def test_signature_follows_its_rule(samples):
    rows = samples.limit(60).select("t", minhash.signature(F.col("t")).alias("sig")).collect()
    for t, sig in rows:
        assert list(sig) == slow_signature(" ".join(t.lower().split()))


def test_signature_of_text_without_shingles():
    assert set(sketch.minima(sketch.shingle_hashes("abcd"))) == {sketch.EMPTY}


def test_signatures_estimate_similarity():
    """Unbiased, and spread like 128 independent draws, for texts of any size."""
    rng, errors, scaled = random.Random(3), [], []
    for _ in range(4000):
        n = rng.choice([40, 200, 800])
        a = "".join(rng.choices("abcdefghijklmnop ", k=n))
        b = a[: rng.randint(5, n - 5)] + "".join(rng.choices("abcdefghijklmnop ", k=n // 3))
        sa, sb = ({t[i : i + 5] for i in range(len(t) - 4)} for t in (a, b))
        same = sketch.minima(sketch.shingle_hashes(a)) == sketch.minima(sketch.shingle_hashes(b))
        share = len(sa & sb) / len(sa | sb)
        errors.append(same.mean() - share)
        scaled.append(errors[-1] / max((share * (1 - share) / 128) ** 0.5, 0.01))
    assert abs(np.mean(errors)) < 0.002
    assert 0.9 < np.std(scaled) < 1.1


# ---- ROUGE ------------------------------------------------------------------
def slow_lcs(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, best[j] = best[j], max(best[j], best[j - 1], last + 1 if x == y else 0)
    return best[-1]


def test_lcs_against_the_table():
    rng = random.Random(5)
    for _ in range(400):
        a, b = (rng.choices("abcd", k=rng.randint(0, 140)) for _ in range(2))
        assert lcs.lcs_length(a, b) == slow_lcs(a, b)


def test_lcs_of_long_texts_with_few_masks_kept(monkeypatch):
    rng = random.Random(6)
    a, b = ([str(rng.randrange(400)) for _ in range(1500)] for _ in range(2))
    want = slow_lcs(a, b)
    assert lcs.lcs_length(a, b) == want
    monkeypatch.setattr(lcs, "MASK_BYTES", 1000)
    assert lcs.lcs_length(a, b) == want
    # Mostly distinct tokens: the masks of all of them would not fit in memory.
    many = [str(i) for i in range(60_000)]
    assert lcs.lcs_length(many[:300], many) == 300


def test_rouge_edges(spark):
    rows = [
        ("the dog sat on the mat", "the cat sat on mat", 8 / 11),
        ("", "x", 0.0),
        ("   ", "x", 0.0),
        ("a", "b", 0.0),
        ("a", None, None),
        ("a", "", None),
    ]
    df = spark.createDataFrame(rows, "p string, r string, want double")
    for p, r, want, got in df.withColumn("got", rouge.rouge_l(F.col("p"), F.col("r"))).collect():
        assert got == (pytest.approx(want) if want is not None else None), (p, r)
