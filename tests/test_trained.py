"""The trained classifier against numpy, held-out rows, and the edges of its input."""

import math
import re

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ledgerfold.operators import trained
from ledgerfold.plans.queries import _quality_labels, all_queries
from ledgerfold.sources.staging import new_location
from tests.conftest import TESTDATA

ROWS = [
    ("good", "the quarter closed with a steady rise in revenue"),
    ("good", "revenue and costs of the quarter are in the report"),
    ("good", "a steady report of revenue"),
    ("poor", "click here now now now to win win"),
    ("poor", "win a prize now and click the link here"),
    ("poor", "click click click the quarter prize here"),
    ("poor", "free prize and a link to click on"),
]


def files(spark, texts):
    rows = [(f"c/{at}", str(at), text) for at, text in enumerate(texts)]
    return spark.createDataFrame(rows, "path string, name string, text string").withColumn("folder", F.lit("x"))


def vectors(spark, texts, buckets):
    rows = spark.createDataFrame([(at, t) for at, t in enumerate(texts)], "at int, _text string")
    made = PipelineModel(trained.features(buckets=buckets)).transform(rows).orderBy("at").collect()
    return np.array([row["_features"].toArray() for row in made])


def numpy_fit(x, y, weights, regularised, steps=60):
    """Newton's method for weighted logistic regression with a free intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], regularised)
    penalty[-1] = 0
    beta, share = np.zeros(x.shape[1]), weights / weights.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        slope = x.T @ (share * (p - y)) + penalty * beta
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        beta -= np.linalg.solve(curve, slope)
    return beta


def test_features_are_counts_of_words_and_pairs(spark):
    (one,) = vectors(spark, ["Über--uns, über uns 7"], 1 << 14)
    words = ["über", "--", "uns", ",", "über", "uns", "7"]
    terms = words + [" ".join(pair) for pair in zip(words, words[1:])]
    counts = sorted(terms.count(t) for t in set(terms))
    assert sorted(one[one > 0] * math.sqrt(sum(c * c for c in counts))) == pytest.approx(counts)


def test_fit_agrees_with_numpy(spark):
    texts = [text for _, text in ROWS]
    model = trained.train(
        spark.createDataFrame(ROWS, "label string, text string"), buckets=64, regularised=0.01, rounds=200
    )
    x = vectors(spark, texts, 64)
    y = np.array([label == "poor" for label, _ in ROWS], float)
    weights = np.where(y == 1, 7 / (2 * 4), 7 / (2 * 3))
    beta = numpy_fit(x, y, weights, 0.01)
    logistic = model.pipeline.stages[-1]
    assert model.labels == ["good", "poor"]
    assert logistic.coefficients.toArray() == pytest.approx(beta[:-1], abs=2e-3)
    assert logistic.intercept == pytest.approx(beta[-1], abs=2e-3)
    rows = {r.path: r for r in trained.classify_trained(files(spark, texts), model).collect()}
    p = 1 / (1 + np.exp(-(x @ beta[:-1] + beta[-1])))
    for at, (label, _) in enumerate(ROWS):
        row = rows[f"c/{at}"]
        assert row.label == label
        assert row.confidence == pytest.approx(max(p[at], 1 - p[at]), abs=0.006)


def test_edges_of_scoring_and_training(spark):
    rows = spark.createDataFrame(ROWS + [(None, "a text nobody has judged yet"), ("good", None), ("new", "short")], "label string, text string")
    model = trained.train(rows, buckets=1 << 12)
    texts = [None, "", "  short ", "click to win a prize now", "????!!!! ........ -----", "quarter " * 300_000]
    found = {r.name: r for r in trained.classify_trained(files(spark, texts), model, keep=("folder",)).collect()}
    assert [found[str(at)].status for at in range(6)] == ["no_text"] * 3 + ["ok"] * 3
    assert found["3"].label == "poor" and found["5"].label == "good" and found["3"].folder == "x"
    assert found["5"].chars == 2_400_000
    assert found["0"].label == "unclassified" and found["0"].confidence == 0.0
    none = files(spark, texts).where("path = ''")
    assert trained.classify_trained(none, model).count() == 0
    for bad in (rows.where("label = 'poor'"), rows.where("label = 'x'")):
        with pytest.raises(trained.NothingToLearn):
            trained.train(bad, buckets=64)


def test_more_than_two_labels_and_storage(spark):
    rows = ROWS + [("mail", "dear sir, with kind regards"), ("mail", "hello and kind regards to you all")]
    model = trained.train(spark.createDataFrame(rows, "label string, text string"), buckets=1 << 12)
    location = new_location(spark, "model")
    model.save(location)
    again = trained.Trained.load(spark, location)
    assert again.labels == ["good", "mail", "poor"]
    texts = [text for _, text in rows]
    first = trained.classify_trained(files(spark, texts), model).orderBy("path").collect()
    assert first == trained.classify_trained(files(spark, texts), again).orderBy("path").collect()
    assert [r.label for r in first] == [label for label, _ in rows]
    with pytest.raises(Exception, match="already exists"):
        model.save(location)


def test_scoring_stays_in_the_jvm(spark):
    model = trained.train(spark.createDataFrame(ROWS, "label string, text string"), buckets=64)
    plan = trained.classify_trained(files(spark, ["a b"]), model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_held_out_quality(spark):
    sf_dir = f"{TESTDATA}/sf0.1"
    found = all_queries()["classify_trained"](spark, sf_dir)
    judged = found.join(_quality_labels(spark, sf_dir).select("doc_id", "truth", "held_out"), "doc_id").where("held_out AND status = 'ok'")
    by_truth = {r.truth: r for r in judged.groupBy("truth").agg(F.count("*").alias("n"), F.avg((F.col("label") == F.col("truth")).cast("int")).alias("right")).collect()}
    assert by_truth.keys() == {"good", "poor"} and min(r.n for r in by_truth.values()) >= 80
    assert all(r.right >= 0.7 for r in by_truth.values()), by_truth
    assert found.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("count(*) + count_if(doc_id % 97 = 0) AS n").first().n
    assert re.fullmatch("likeliest of 2 trained labels|no extractable text .*", found.first().reason)
