"""The quality classifier: held-out figures on the driver tables, the loss it learns by, and odd tables."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import quality, queries

DIR = "/root/testdata/sf0.01"


def area(scores, labels):
    """The part of pairs of a 1 and a 0 in which the 1 has the higher score; ties count half."""
    ones, zeros = np.sort(scores[labels == 1]), scores[labels == 0]
    below = np.searchsorted(ones, zeros, side="left"), np.searchsorted(ones, zeros, side="right")
    return float(((len(ones) - below[1]) + (below[1] - below[0]) / 2).mean() / len(ones))


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables")
def test_held_out_rows(spark):
    found = queries.QUERIES["op11_quality"](spark, DIR)
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == docs.count()
    rows = found.join(labels, "doc_id").where("held_out").collect()
    scores, truth, said = (np.array([r[c] for r in rows]) for c in ("score", "quality", "predicted"))
    assert len(rows) > 50 and 0 <= scores.min() and scores.max() <= 1 and ((scores >= 0.3) == (said == 1)).all()
    assert area(scores, truth) > 0.98 and (said == truth).mean() > 0.95
    again = {r["doc_id"]: r["score"] for r in queries.QUERIES["op11_quality"](spark, DIR).collect()}
    assert all(again[r["doc_id"]] == r["score"] for r in rows)


def test_held_out_labels_teach_nothing(spark):
    """Labels of held-out rows are turned round: no score changes."""
    docs = spark.createDataFrame([(i, " ".join(["buy now"] * 9) if i % 2 else f"plain text number {i} goes here with words", "x", 1.0) for i in range(200)], "doc_id long, text string, lang string, score double")
    labels = docs.select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"))
    other = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: (r["score"], r["predicted"]) for r in quality.classify(docs, t, learn_from=~quality.held_out()).collect()} for t in (labels, other))
    assert a == b and all(p == 1 - i % 2 for i, (_, p) in a.items())


def test_loss_falls_to_the_best_order():
    """Bradley-Terry on made-up strengths: the learned order is that of the true weights, and no weight for noise."""
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(600, 3))
    true = 6 * x[:, 0] - 3 * x[:, 1]
    better = rng.uniform(size=600) < 1 / (1 + np.exp(-true + 1.5))
    w = quality.bradley_terry(x[better], x[~better])
    assert w[0] > 3 and w[1] < -1 and abs(w[2]) < 1
    up, down = x[better] @ w, x[~better] @ w
    loss = lambda v: float(np.log1p(np.exp(-(x[better] @ v)[:, None] + (x[~better] @ v)[None, :])).mean())  # noqa: E731  (all pairs)
    assert loss(w) < loss(np.zeros(3)) and all(loss(w) < loss(w + d) for d in (np.eye(3) * 1.5))
    assert up.mean() > down.mean()


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "Same text here"), (5, "Same text here"), (5, "Same text here"), (None, "no id at all"), (None, None), (6, "漢字 🙂 \U0010ffff ß"), (7, "x" * 300_000), (8, "word " * 300_000), (9, "\n\n")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", 0.5, 1, "m", 2) for i, t in ODD], "doc_id long, text string, lang string, score double, predicted int, m string, raw int")


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 0), (4, 0, 1), (5, 1, 0), (6, None, 0), (None, 1, 0), (7, 5, 0), (8, 0, 0), (9, 1, None), (77, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (1, 2, 3, 9)}
    assert len(empty) == 1 and len({r["score"] for r in got if r["doc_id"] in (4, 5)}) == 1


def test_without_labels_or_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (none, spark.createDataFrame([(4, 1)], "doc_id long, quality int"), spark.createDataFrame([(99, 0), (98, 1)], "doc_id long, quality int")):
        got = quality.classify(odd, labels).collect()
        assert len(got) == len(ODD) and {r["predicted"] for r in got} == {1}
    assert quality.classify(odd.where("false"), none).collect() == []


def test_blocks_give_the_measures_of_the_whole_text(monkeypatch):
    text = "Some words, SOME words. some WORDS\nwith 12 lines\n" * 50
    whole = quality.measures(text)
    monkeypatch.setattr(quality, "BLOCK", 100)
    parts = quality.measures(text)
    same = [i for i, name in enumerate(quality.MEASURES) if name not in ("repeated_lines", "lines")]  # a line that a block cuts is two
    assert whole[same] == pytest.approx(parts[same]) and len(whole) == len(quality.MEASURES)
    assert quality.measures("a a a a")[quality.MEASURES.index("repeated_neighbours")] == 1 and not quality.measures(" ").any()
