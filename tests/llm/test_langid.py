import numpy as np
import pytest
from pyspark.sql import functions as F

from stowage.llm import langid
from stowage.llm.learn import remainder
from stowage.llm.queries import op1_language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    rows = op1_language_id(spark, SF).join(truth, "doc_id").collect()
    held = [r for r in rows if r.held_out and r.n >= 20]
    assert len(held) > 200
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    right = [r.score for r in rows if r.lang_pred == r.lang]
    assert np.mean(right) > 0.9


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.learn(docs, F.lit(True), remainder("doc_id", 64) == 1)


def test_awkward_rows(awkward, model):
    rows = langid.identify(awkward, model).collect()
    assert len(rows) == awkward.count()
    texts = {r.doc_id: r.text for r in awkward.select("doc_id", "text").collect()}
    for r in rows:
        if any(map(str.isalpha, texts[r.doc_id] or "")):
            assert r.lang_pred in model.langs
        else:
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)


def test_unlike_text_is_rejected(spark, model):
    docs = spark.createDataFrame([(1, "zqxj vkwq zzqj xqvk " * 20), (2, "Привет мир как дела " * 20)], "doc_id long, text string")
    assert all(r.rejected for r in langid.identify(docs, model).collect())


def test_nothing_to_learn(awkward, empty):
    assert langid.learn(empty, F.lit(True), F.lit(False)) is None
    assert {r.lang_pred for r in langid.identify(awkward, None).collect()} == {"und"}
    assert langid.identify(empty, None).count() == 0


def test_probabilities_are_those_of_plain_counting():
    """Interpolated Kneser-Ney from the definition, over a small text; and sums of one."""
    documents = ["abab cab", "bca abc ab", "cabba"]
    packed, starts = langid.grams(documents)
    keys, counts = np.unique(packed, return_counts=True)
    model = langid.fit(["x"], {"x": (keys, counts.astype(np.int64))})

    split = lambda k: tuple(int(k) >> 15 * (3 - i) & 0x7FFF for i in range(4))
    level = {4: {split(k): int(c) for k, c in zip(keys, counts)}}
    for n in (3, 2, 1):
        level[n] = {}
        for gram in level[n + 1]:
            level[n][gram[1:]] = level[n].get(gram[1:], 0) + 1
    alphabet = len({g[-1] for g in level[4]}) + 1

    def probability(gram):
        if not gram:
            return 1 / alphabet
        table = level[len(gram)]
        ones, twos = sum(c == 1 for c in table.values()), sum(c == 2 for c in table.values())
        discount = min(0.95, ones / (ones + 2 * twos)) if ones else 0.1
        own = {g: c for g, c in table.items() if g[:-1] == gram[:-1]}
        if not own:
            return probability(gram[1:])
        total = sum(own.values())
        return max(own.get(gram, 0) - discount, 0) / total + discount * len(own) / total * probability(gram[1:])

    symbols = sorted({g[-1] for g in level[4]})
    contexts = {g[:3] for g in level[4]} | {(9, 9, 9), (symbols[0], 9, symbols[1])}
    for context in contexts:
        grams = [(*context, s) for s in symbols]
        asked = np.array([sum(v << 15 * (3 - i) for i, v in enumerate(g)) for g in grams], np.uint64)
        got = np.exp(langid.log_probabilities(model, asked)[:, 0])
        assert np.allclose(got, [probability(g) for g in grams])
        assert got.sum() <= 1 + 1e-9


def test_counts_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    models = [langid.learn(docs.repartition(n), F.lit(True), F.lit(False)) for n in (1, 7)]
    assert all(np.array_equal(a, b) for a, b in zip(models[0].keys, models[1].keys))
    assert all(np.allclose(a, b, equal_nan=True) for a, b in zip(models[0].logs, models[1].logs))


def test_all_grams_are_kept(spark):
    """Four languages of random letters, 2.7 million n-grams: the models are those of the whole counts."""
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzäöüßéèêñçøåæ"))
    texts = ["".join(rng.choice(letters, 800_000)) for _ in range(4)]
    docs = spark.createDataFrame([(i, f"l{i}", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    model = langid.learn(docs, F.lit(True), F.lit(False))
    each = [np.unique(langid.grams([t])[0]) for t in texts]
    assert sum(map(len, each)) > 2_000_000
    assert min(map(len, each)) > 500_000
    top = model.logs[langid.ORDER - 1]
    assert [int((~np.isnan(top[:, j])).sum()) for j in range(4)] == [len(e) for e in each]
