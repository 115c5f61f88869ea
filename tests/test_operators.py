import random

import pytest
from pyspark.sql import Window, functions as F

from stowage.functions.shards import shard_of
from stowage.operators.batches import number_batches
from stowage.operators.conditions import after_key, until_key
from stowage.operators.keys import duplicate_keys, last_wins, repeated_rows
from stowage.operators.numbering import last_before, number_rows
from stowage.sources.files import Folder, Scratch, shared_folder


@pytest.fixture
def scratch(spark):
    scratch = Scratch(spark)
    yield scratch
    scratch.remove()


def test_number_rows_equals_a_window(spark, scratch, lines):
    """One part holds most rows; another is NULL."""
    df = lines.withColumn("seq", F.monotonically_increasing_id()).withColumn(
        "part", F.when(F.col("l_quantity") > 15, "hot").when(F.col("l_quantity") > 3, F.col("l_linestatus"))
    )
    df = scratch.table(df, "input")
    order = ["l_shipdate", "l_orderkey", "seq"]
    window = Window.partitionBy("part").orderBy(*order)
    expected = {r.seq: r.n for r in df.withColumn("n", F.row_number().over(window)).collect()}
    got = number_rows(df.repartition(9), order, scratch, ["part"], name="n")
    assert {r.seq: r.n for r in got.collect()} == expected
    assert got.select("part", "_chunk").where("part = 'hot'").distinct().count() > 1


def test_number_rows_of_few_rows(spark, scratch):
    df = spark.createDataFrame([(3,), (1,), (2,)], "a int")
    assert {r.a: r.row_number for r in number_rows(df, ["a"], scratch).collect()} == {1: 1, 2: 2, 3: 3}
    assert number_rows(df.where("a > 5"), ["a"], scratch).count() == 0


def test_batches_of_input_partitions(spark, scratch):
    df = scratch.table(spark.range(0, 103, 1, 4).withColumn("seq", F.monotonically_increasing_id()), "input")
    got = number_batches(df, 10, "seq", scratch).groupBy("write_part", "batch").agg(
        F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")
    )
    rows = sorted(tuple(r) for r in got.collect())
    assert sum(r[2] for r in rows) == 103
    assert {r[0] for r in rows} == {0, 1, 2, 3}
    for part, batch, n, low, high in rows:
        assert high - low + 1 == n and n <= 10
        if (part, batch + 1) in {(r[0], r[1]) for r in rows}:
            assert n == 10
    with pytest.raises(ValueError):
        number_batches(df, 0, "seq", scratch)


def test_last_wins_of_copies(spark):
    rows = [("hot", i, f"v{i}") for i in range(300)] + [("cold", 1, "c"), ("cold", 1, "c")]
    df = spark.createDataFrame(rows, "k string, n int, v string").repartition(6)
    assert {tuple(r) for r in last_wins(df, ["k"], ["n"]).collect()} == {("hot", 299, "v299"), ("cold", 1, "c")}
    assert last_wins(df, ["k"], ["n"]).columns == df.columns
    assert repeated_rows(df, ["k"]) == 300
    assert {tuple(r) for r in duplicate_keys(df, ["k", "n"]).collect()} == {("cold", 1, 2)}


def test_last_wins_reduces_before_the_shuffle(spark, lines):
    plan = last_wins(lines, ["l_returnflag"], ["l_shipdate"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_key_comparisons(spark):
    random.seed(3)
    values = [None, 1, 2, 3]
    rows = [(a, b, c) for a in values for b in values for c in values]
    df = spark.createDataFrame(rows, "a int, b int, c int")

    def place(row):
        return [(v is not None, v or 0) for v in row]

    for _ in range(6):
        at = random.choice(rows)
        columns = [F.col(c) for c in "abc"]
        after = {tuple(r) for r in df.where(after_key(columns, at)).collect()}
        assert after == {r for r in rows if place(r) > place(at)}
        until = {tuple(r) for r in df.where(until_key(columns, at)).collect()}
        assert until == set(rows) - after


def test_shard_of(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, t string")
    got = df.select(shard_of([F.col("id")], 4).alias("s"), shard_of([F.col("id"), F.col("t")], 4).alias("c")).collect()
    # md5 of "1" starts with c4ca4238, of "2" with c81e728d
    assert [r.s for r in got] == [0xC4CA4238 % 4 + 1, 0xC81E728D % 4 + 1, None]
    assert got[2].c is None and all(1 <= r.c <= 4 for r in got[:2])


def test_folder(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "a"))
    assert folder.names() == [] and not folder.exists()
    assert folder.publish("x.json", "first ü")
    assert not folder.publish("x.json", "second")
    assert folder.read("x.json") == "first ü"
    assert [n for n in folder.names() if not n.startswith(".")] == ["x.json"]
    folder.remove("x.json")
    assert not folder.exists("x.json")


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_the_last_value_before_a_row(spark, tmp_path):
    """Also across the ranges that rows are spread over, in a part that fills most of them."""
    rows = [("hot" if i % 10 else f"p{i % 3}", i, i if i % 7 == 0 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "part string, at int, value int")
    found = last_before(df, ["at"], "value", Scratch(spark, str(tmp_path)), ["part"], "last")
    expected, last = {}, {}
    for part, at, value in rows:
        expected[at] = last.get(part)
        last[part] = last.get(part) if value is None else value
    assert {r["at"]: r["last"] for r in found.collect()} == expected
