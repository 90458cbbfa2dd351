import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import fitting, quality, queries, toxicity

FOLDER = "/root/testdata/sf0.1"  # smaller ones hold too few toxic texts of some languages


def area(scores, flags):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    flags = np.array(flags) == 1
    return (ranks[flags].sum() - flags.sum() * (flags.sum() + 1) / 2) / (flags.sum() * (~flags).sum())


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = queries.queries()["op8_quality"](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert area([s for s, _, _ in held], [y for _, y, _ in held]) > 0.97
    assert np.mean([y == p for _, y, p in held]) > 0.93


def test_toxicity_finds_labelled_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = queries.queries()["op7_toxicity"](spark, FOLDER).collect()
    known = [(r.severity, labels[r.doc_id], r.toxic) for r in rows if r.doc_id in labels]
    assert area([s for s, _, _ in known], [y for _, y, _ in known]) > 0.95
    assert np.mean([t for _, y, t in known if y]) > 0.8
    assert np.mean([t for _, y, t in known if not y]) < 0.02
    assert all(0 <= r.severity <= toxicity.GRADES and 0 <= r.grade <= toxicity.GRADES for r in rows)


def test_toxicity_on_held_out_rows(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "toxic")
    out = queries.held_out(F.col("doc_id"))
    model = toxicity.fit_flags(documents, labels.filter(~out))
    held = toxicity.score(documents, model).join(labels.filter(out).withColumnRenamed("toxic", "flag"), "doc_id").collect()
    assert area([r.severity for r in held], [r.flag for r in held]) > 0.9
    assert np.mean([r.toxic for r in held if r.flag]) > 0.6
    assert np.mean([r.toxic for r in held if not r.flag]) < 0.02


@pytest.mark.parametrize("n", [1, 999, 1000, 2001])
def test_one_model_for_any_number_of_rows(spark, n):
    """What the task learns is what the rows give in one go; a key of several texts counts once."""
    table = spark.range(n).selectExpr("id as doc_id", "concat('word', id % 7, ' ', if(id % 3 = 0, 'bad bad', 'fine')) as text")
    labels = table.selectExpr("doc_id", "cast(doc_id % 3 = 0 as int) as y")
    twice = table.union(table.selectExpr("doc_id", "concat(text, ' zzz')"))
    model = fitting.fit(fitting.sparse_rows(twice, fitting.sample(labels, "doc_id", "y"), quality.features, "doc_id", "text"), quality.learn, 0)
    rows = [(r.y, p, v) for r, (p, v) in zip(labels.collect(), quality.features(pa.array([r.text for r in table.collect()])))]
    frame = pd.DataFrame([(y, p.astype("<i4").tobytes(), v.astype("<f4").tobytes()) for y, p, v in rows], columns=["y", "p", "v"])
    frame = frame.sort_values(["y", "p", "v"], ignore_index=True).sample(frac=1, random_state=7, ignore_index=True)
    want = quality.learn(
        frame["y"].to_numpy(), [np.frombuffer(p, "<i4") for p in frame["p"]], [np.frombuffer(v, "<f4").astype(float) for v in frame["v"]]
    )
    assert np.allclose(model, want)


def test_learning_by_hand():
    """Follow the regularised leader, weight by weight in plain Python."""
    rows = [(1, [0, 3], [1.0, 0.5]), (0, [1, 3], [1.0, 0.25]), (1, [0, 2], [0.5, 1.0])] * 3
    z, n = [0.0] * 4, [0.0] * 4

    def weight(i):
        shrunk = max(abs(z[i]) - 1e-3, 0) * (1 if z[i] > 0 else -1)
        return -shrunk / (1.0 + n[i] ** 0.5 + 1e-3)

    for _ in range(quality.EPOCHS):
        for y, at, x in rows:
            w = [weight(i) for i in at]
            p = 1 / (1 + np.exp(-sum(a * b for a, b in zip(w, x))))
            for i, xi, wi in zip(at, x, w):
                g = (p - y) * xi
                sigma = (n[i] + g * g) ** 0.5 - n[i] ** 0.5
                z[i] += g - sigma * wi
                n[i] += g * g
    got = quality.learn(np.array([r[0] for r in rows]), [np.array(r[1]) for r in rows], [np.array(r[2]) for r in rows])
    assert np.allclose(got[:4], [weight(i) for i in range(4)])


def _graded(spark, n=600, seed=1):
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        grade = int(draw.integers(0, 4)) if i % 3 == 0 else 0
        own = [f"plain{draw.integers(60)}" for _ in range(40)] + [f"foul{draw.integers(12)}" for _ in range(3 * grade)]
        draw.shuffle(own)
        rows.append((i, " ".join(own), grade))
    return spark.createDataFrame(rows, "doc_id bigint, text string, grade int")


def test_grades_are_ordered(spark):
    table = _graded(spark)
    model = toxicity.fit(table, table.select("doc_id", "grade"))
    limits = model[-toxicity.GRADES :]
    assert (np.diff(limits) > 0).all()
    fresh = _graded(spark, seed=2)
    scored = toxicity.score(fresh, model).toPandas().merge(fresh.toPandas(), on="doc_id", suffixes=("", "_true"))
    mean = scored.groupby("grade_true")["severity"].mean()
    assert mean.is_monotonic_increasing
    assert ((scored["grade"] > 0) == (scored["grade_true"] > 0)).mean() > 0.95


def test_gradient_of_the_likelihood():
    """The steps end where no small change of the model raises the likelihood much."""
    draw = np.random.default_rng(0)
    places = [np.flatnonzero(draw.random(6) < 0.5) for _ in range(400)]
    targets = np.array([min(3, len(p[p < 3])) for p in places])
    model = toxicity.learn(targets, places, None, screen=0.0)
    weights, limits = model[: 1 << toxicity.BITS], model[-toxicity.GRADES :]

    def loss(w, limits):
        above = 1 / (1 + np.exp(limits - np.array([w[p].sum() for p in places])[:, None]))
        full = np.hstack([np.ones((400, 1)), above, np.zeros((400, 1))])
        return -np.log(full[np.arange(400), targets] - full[np.arange(400), targets + 1] + 1e-12).mean()

    start = loss(np.zeros(1 << toxicity.BITS), np.array([0.0, 1.0, 2.0]))
    assert loss(weights, limits) < 0.4 * start


@pytest.mark.parametrize("kind", [quality, toxicity])
def test_odd_rows(spark, kind):
    table = spark.createDataFrame(
        [(1, "good words here", "x"), (2, None, "x"), (3, "", "x"), (None, "words", "x"), (1, "good words here", "x"), (4, "w " * 200000, "x")],
        "doc_id bigint, text string, severity string",
    )
    model = np.zeros((1 << kind.BITS) + (1 if kind is quality else toxicity.GRADES))
    model[3] = 1.0
    rows = kind.score(table, model).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "2", "3", "4", "None"]
    ones = [tuple(r) for r in rows if r.doc_id == 1]
    assert ones[0] == ones[1]
    assert kind.score(table.limit(0), model).collect() == []


def test_no_labels(spark):
    table = spark.createDataFrame([(1, "some text")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert quality.score(table, quality.fit(table, labels, "quality")).first().score == 0.5
    assert not toxicity.score(table, toxicity.fit_flags(table, labels)).first().toxic
    assert toxicity.keep_clean(table, toxicity.fit_flags(table, labels)).count() == 1


def test_sample_is_bounded(spark):
    labels = spark.range(20000).selectExpr("id as doc_id", "cast(id % 2 as int) as y")
    n = fitting.sample(labels.unionByName(labels), "doc_id", "y", 1000).count()
    assert 800 < n < 1200


def test_features_do_not_depend_on_slices():
    texts = pa.array(["One two, two!! 33 x", None, "", "a " * 50, "Große Straße"])
    for kind in (quality, toxicity):
        whole = list(kind.features(texts))
        single = [f for text in texts for f in kind.features(pa.array([text.as_py()], pa.string()))]
        for (a, x), (b, y) in zip(whole, single, strict=True):
            assert (a == b).all() and np.allclose(x, y)
