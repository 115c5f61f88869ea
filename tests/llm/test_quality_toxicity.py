import numpy as np
import pytest
from pyspark.sql import functions as F

from stowage.llm import quality, toxicity
from stowage.llm.learn import lasso_logistic, logistic
from stowage.llm.queries import op5_quality, op7_toxicity

SF = "/root/testdata/sf0.01"


def judged(result, spark, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = result.join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    return np.array([r.predicted for r in held]), np.array([r[label] for r in held])


def test_quality_on_held_out_rows(spark):
    predicted, truth = judged(op5_quality(spark, SF), spark, "quality")
    assert len(truth) > 50 and (predicted == truth).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    predicted, truth = judged(op7_toxicity(spark, SF), spark, "toxic")
    assert (predicted == truth).mean() > 0.93
    assert predicted[truth == 0].mean() < 0.03 and predicted[truth == 1].mean() > 0.6


def test_statistics_of_awkward_rows(awkward):
    rows = quality.statistics(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(np.isfinite(r[s]) for r in rows for s in quality.STATISTICS)
    blank = [r for r in rows if r.doc_id == 1][0]
    assert all(blank[s] == 0 for s in quality.STATISTICS)


def test_statistics_by_hand(spark):
    text = "Aa bb bb! XX|\nAa bb bb! XX|\n1"
    r = quality.statistics(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    n = len(text)
    assert r.log_words == pytest.approx(np.log1p(9))
    assert r.exclaim_share == pytest.approx(2 / n) and r.pipe_share == pytest.approx(2 / n)
    assert r.upper_share == pytest.approx(6 / n) and r.digit_share == pytest.approx(1 / n)
    assert r.caps_words == pytest.approx(2 / 9) and r.marked_words == pytest.approx(4 / 9)
    assert r.distinct_words == pytest.approx(5 / 9) and r.top_word == pytest.approx(2 / 9)
    assert r.repeated_lines == pytest.approx(1 / 3) and r.repeated_words == 0


def test_rules_are_the_same_as_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    measured = quality.statistics(docs)
    rules = quality.learn(measured, spark.read.parquet(f"{SF}/labels.parquet"), "quality")
    assert 0 < len(rules.rules) < 150
    rows = quality.score(measured.select("*"), rules).collect()
    table = measured.toPandas().set_index("doc_id")
    x = table[list(quality.STATISTICS)].to_numpy()
    z = rules.intercept + sum(r.weight * r.holds(x) for r in rules.rules)
    want = dict(zip(table.index, 1 / (1 + np.exp(-z))))
    assert all(abs(r.score - want[r.doc_id]) < 1e-9 for r in rows)


def test_without_labels(spark, documents, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    measured = quality.statistics(documents)
    assert {r.score for r in quality.score(measured, quality.learn(measured, none, "quality")).collect()} == {0.5}
    labelled = toxicity.labelled_texts(documents, none, "toxic")
    signs = toxicity.choose(labelled)
    voted = toxicity.votes(documents, signs)
    scores = voted.select(toxicity.learn(voted, labelled, signs).score().alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in scores)
    nothing = toxicity.votes(empty, signs)
    assert nothing.select(toxicity.learn(nothing, toxicity.labelled_texts(empty, none, "toxic"), signs).score()).count() == 0


def test_votes_of_awkward_rows(spark, awkward):
    docs = awkward.select("doc_id", "text").union(
        spark.createDataFrame([(30, "You IDIOT, you stupid clown."), (31, "A calm sentence.")], "doc_id long, text string")
    )
    signs = toxicity.Signs(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    rows = {r.doc_id: r for r in toxicity.votes(docs, signs).collect()}
    assert len(rows) == docs.select("doc_id").distinct().count()
    assert rows[30].insult == 2 and rows[30].contempt == 1 and rows[30].addressed >= 2 and rows[30].several == 2
    assert all(rows[31][v] == 0 for v in toxicity.VOTERS) and rows[31].n_words == 3


def test_label_model_finds_accuracies_and_correlations():
    """Four independent voters and one that is there three times."""
    rng = np.random.default_rng(2)
    truth = rng.random(30000) < 0.2
    rates = np.array([[0.05, 0.02, 0.1, 0.03, 0.05], [0.7, 0.5, 0.8, 0.6, 0.6]])
    fired = rng.random((30000, 5)) < rates[truth.astype(int)]
    fired = np.column_stack([fired, fired[:, 4], fired[:, 4]])
    patterns, mass = np.unique(fired, axis=0, return_counts=True)
    known = rng.random(30000) < 0.02
    model = toxicity.label_model(patterns, mass, fired[known], truth[known].astype(float), np.ones(known.sum()))
    assert np.abs(model.rates[1][:4] - rates[1][:4]).max() < 0.1
    assert model.shares[4] < 0.5 < model.shares[0]
    assert ((model.posterior(fired) > 0.5) == truth).mean() > 0.93


def test_small_models():
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(4000), rng.normal(size=(4000, 6))])
    true = np.array([-0.5, 2, 0, 0, -1.5, 0, 0])
    y = (rng.random(4000) < 1 / (1 + np.exp(-x @ true))).astype(float)
    assert np.abs(logistic(x, y) - true).max() < 0.25
    sparse = lasso_logistic(x, y, 0.03)
    assert (sparse[[2, 3, 5, 6]] == 0).all() and sparse[1] > 0.5 and sparse[4] < -0.3


def test_samples_are_bounded(spark):
    from stowage.llm.learn import bounded_sample

    rows = spark.range(20000)
    n = bounded_sample(rows, 1000, 20000, "id").count()
    assert 800 < n < 1200
    assert bounded_sample(rows, 20000, 20000, "id").count() == 20000
    assert bounded_sample(rows.where(F.lit(False)), 10, 0, "id").count() == 0
