import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stowage.llm import quality
from stowage.llm.learn import remainder

from test_decontam import brute as all_leaks
from test_jaccard import brute as all_groups
from test_packing import expected
from test_pii import base_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input of the first stage and the output of each, written and read again as the pipeline does."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], SF).write.parquet(str(folder / name))
        tables.append(spark.read.parquet(str(folder / name)))
    return tables


def test_stages_are_the_ones_dealt():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns(steps):
    assert all(t.columns == steps[0].columns for t in steps[1:-1])


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_quality_stage(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = set(ids(steps[1]))
    judged = [d for d in ids(steps[0]) if d in labels]
    assert np.mean([(d in kept) == labels[d] for d in judged]) > 0.9
    assert steps[1].exceptAll(steps[0]).isEmpty()


def test_near_duplicates_stage(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    want = sorted(d for d, n, c in all_groups(rows, 5, 80) if n == 0 or d == c)
    assert ids(steps[2]) == want and steps[2].exceptAll(steps[1]).isEmpty()


def test_decontamination_stage(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in steps[2].collect() if len(r.text) < 4000]
    leaks = {d for d, _ in all_leaks(rows, items)}
    kept = set(ids(steps[3]))
    assert leaks and {d for d, _ in rows} - kept == leaks
    assert steps[3].exceptAll(steps[2]).isEmpty()


def test_pii_stage(steps):
    before = {r.doc_id: r for r in steps[3].collect()}
    after = {r.doc_id: r for r in steps[4].collect()}
    assert before.keys() == after.keys()
    for doc, old in before.items():
        new = after[doc]
        assert (new.lang, new.source, new.n_chars) == (old.lang, old.source, old.n_chars)
        assert not base_spans(new.text)
        if not base_spans(old.text) and "token = " not in old.text:
            assert new.text == old.text


def test_packing_stage(steps):
    from tokenizers import Tokenizer

    from stowage.llm.queries import tokenizer_path

    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = sorted((r.doc_id, r.piece, r.start, r.length) for r in steps[5].collect())
    want = sorted((r.doc_id, k, s, n) for r in steps[4].collect() for k, s, n, _ in expected(tokenizer, r.text))
    assert got == want


def test_run_is_the_stages(spark, steps):
    whole = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert whole.select(columns).exceptAll(steps[5].select(columns)).isEmpty()
    assert whole.count() == steps[5].count()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]])
def test_stages_take_awkward_rows(spark, awkward, empty, stage):
    out = stage(spark, awkward, SF)
    assert out.columns == awkward.columns
    assert out.select("doc_id").exceptAll(awkward.select("doc_id")).isEmpty()
    assert stage(spark, empty, SF).count() == 0


def test_packing_takes_awkward_rows(spark, awkward, empty):
    rows = corpus_pipeline.pack(spark, awkward, SF).collect()
    assert sorted(str(r.doc_id) for r in rows if r.piece == 0) == sorted(str(r.doc_id) for r in awkward.select("doc_id").collect())
    assert all(r.length == 1 for r in rows if r.doc_id in (1, 2, 3))
    assert {r.piece for r in rows if r.doc_id == 6} == set(range(7))
    placed = {}
    for r in rows:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert corpus_pipeline.pack(spark, empty, SF).count() == 0


def test_repeated_rows_stay_once(spark, awkward):
    rows = corpus_pipeline.keep_one_of_each(spark, awkward, SF).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(["1", "2", "3", "4", "None", "6", "7", "8"])


def test_copies_go_by_row(spark):
    """An id with two texts, copies under one id, and copies without an id: one row of each group stays."""
    words = [" ".join(f"{kind}{i}" for i in range(60)) for kind in "abcd"]
    rows = [
        (1, words[0]), (5, words[0] + " end"), (5, words[1]), (5, words[1]),  # a copy of 1, and a text of its own twice
        (7, words[2]), (7, words[2] + " end"),  # near copies under the least id
        (None, words[3]), (None, words[3]), (None, words[3] + " end"), (None, words[1] + " end"),
        (None, ""), (None, ""), (8, ""), (8, ""), (9, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_each(spark, docs, SF).collect()]
    assert len(got) == len([d for d in got if d in rows]) == 8
    count = lambda doc, text: sum(d == doc and (t or "").startswith(text) for d, t in got)
    assert [count(1, words[0]), count(5, words[0]), count(5, words[1]), count(7, words[2])] == [1, 0, 1, 1]
    assert [count(None, words[3]), count(None, words[1]), got.count((None, "")), got.count((8, "")), got.count((9, None))] == [1, 0, 2, 1, 1]


def test_quality_decisions_are_the_rules(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(remainder("doc_id", 3) != 1)
    measured = quality.statistics(steps[0])
    rules = quality.learn(measured, labels, "quality")
    good = measured.where(rules.score() >= 0.5).select("doc_id")
    assert ids(good) == ids(steps[1])


def test_rows_of_other_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra.dotted", F.lit(1)).withColumn("row", F.lit("x"))
    out = corpus_pipeline.drop_leaks(spark, docs, SF)
    assert out.columns == docs.columns
