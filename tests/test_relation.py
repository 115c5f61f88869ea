"""The data source, the caller's partitioner, limits of any size and the walk."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThanOrEqual, StringContains

from stowage import Conditions, Field, Index, SpaceSpec
from stowage.operators import paging
from stowage.sources.partitioner import Partitioner
from stowage.sources.relation import SpaceReader, register

SPEC = SpaceSpec(
    (Field("id", "unsigned"), Field("name", "string", True), Field("at", "datetime", True), Field("price", "decimal", True)),
    (Index("id", ("id",)), Index("name", ("name",), unique=False)),
)


@pytest.fixture
def filled(spark, store):
    store.create("things", SPEC)
    rows = spark.range(1000).select(
        "id",
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("n"), F.col("id") % 50)).alias("name"),
        F.timestamp_seconds(F.col("id") * 1000).alias("at"),
        (F.col("id") / 4).cast("decimal(18,2)").alias("price"),
    )
    store.write(rows, "things")
    register(spark, store.root)
    return store


def test_whole_space_keeps_types(spark, filled):
    df = spark.read.format("stowage").option("space", "things").load()
    assert df.schema == filled.schema("things")
    assert sorted(df.collect()) == sorted(filled.scan("things").collect())


def test_columns_and_schema_narrow_what_is_read(spark, filled):
    one = spark.read.format("stowage").option("columns", "name").load(space="things")
    assert one.columns == ["name"] and one.count() == 1000
    two = spark.read.format("stowage").schema("price decimal(38,18), id bigint").load(space="things")
    assert two.columns == ["price", "id"] and two.where("id = 8").first().price == 2
    with pytest.raises(Exception, match="no fields"):
        spark.read.format("stowage").schema("other int").load(space="things").collect()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().replace("RuntimeFilters", "")


def test_comparisons_leave_out_files_and_leave_the_plan(spark, filled):
    df = spark.read.format("stowage").load(space="things")
    all_files = df.rdd.getNumPartitions()
    late = df.where("id > 900")
    assert all_files > 1 and late.rdd.getNumPartitions() < all_files
    assert "Filter" not in plan_of(late)
    assert {r.id for r in late.collect()} == set(range(901, 1000))
    for condition in ("name = 'n3' AND id <= 500", "id IN (3, 4, 2000)", "name IS NOT NULL AND name >= 'n48'"):
        asked = df.where(condition)
        assert "Filter" not in plan_of(asked)
        assert sorted(asked.collect()) == sorted(filled.scan("things").where(condition).collect())
    for condition in ("price > 3", "name LIKE '%9%'", "at < '1970-01-02'", "id % 2 = 0", "id > 5 OR name = 'n1'"):
        asked = df.where(condition)
        assert "Filter" in plan_of(asked)
        assert asked.count() == filled.scan("things").where(condition).count()


def test_reader_takes_what_compares_alike(filled):
    reader = SpaceReader(f"{filled.root}/things", SPEC, SPEC.schema())
    left = [StringContains(("name",), "a"), GreaterThan(("price",), 1), EqualTo(("name", "inner"), "x")]
    taken = [GreaterThan(("id",), 10), LessThanOrEqual(("id",), 20), In(("id",), (15, None)), IsNotNull(("price",))]
    assert list(reader.pushFilters(left + taken)) == left
    assert len(reader.partitions()) == 1
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 1


def test_a_space_without_rows_and_missing_settings(spark, store):
    store.create("none", SPEC)
    register(spark, store.root)
    assert spark.read.format("stowage").load(space="none").count() == 0
    for reader in (spark.read.format("stowage"), spark.read.format("stowage").option("space", "nowhere")):
        with pytest.raises(Exception, match="no space"):
            reader.load().collect()


class ByName(Partitioner):
    index = "name"

    def bounds(self, store, space, conditions):
        return [("n10",), ("n3",)]


def test_partitioner(spark, filled):
    df = filled.scan("things", partitioner=ByName()).withColumn("part", F.spark_partition_id())
    assert df.rdd.getNumPartitions() == 3
    for r in df.collect():
        assert r.part == (0 if r.name is None or r.name <= "n10" else 1 if r.name <= "n3" else 2)
    assert filled.scan("things", partitioner=Partitioner()).rdd.getNumPartitions() == 1
    with pytest.raises(ValueError):
        filled.scan("things", partitioner=Partitioner(), partitions=2)


@pytest.mark.parametrize("index, order", [("id", ["id"]), ("name", ["name", "id"])])
@pytest.mark.parametrize("limit", [0, 1, 499, 1000, 5000])
def test_large_limits_are_found_by_ranges(filled, monkeypatch, index, order, limit):
    monkeypatch.setattr("stowage.sources.store.SMALL", 0)
    rows = filled.scan("things", conditions=Conditions(index=index).with_limit(limit)).collect()
    assert rows == filled.scan("things").orderBy(*order).limit(limit).collect()


def test_walk(filled, monkeypatch):
    monkeypatch.setattr(paging, "_RANGE_ROWS", 90)
    pages = list(filled.walk("things", "name", size=64))
    assert [len(p) for p in pages] == [64] * 15 + [40]
    assert [r for p in pages for r in p] == filled.scan("things").orderBy("name", "id").collect()
    late = Conditions.index_greater_than("id", [990])
    assert [r.id for p in filled.walk("things", size=4, columns=["price"], conditions=late) for r in p] == list(range(991, 1000))


def test_a_walk_sends_few_bytes_a_row(spark, store):
    """Rows come to the driver compressed; they keep nulls, times, decimals and nested values."""
    df = spark.range(20_000).selectExpr(
        "id", "id div 10 AS customer", "timestamp_seconds(1700000000 + id) AS at", "CAST(id AS decimal(20,2)) AS price",
        "IF(id % 3 = 0, NULL, array(struct(id AS a, 'x' AS b))) AS parts",
    )
    assert [r for p in paging.walk_pages(df, ["customer", "id"], 700, 20_000) for r in p] == df.orderBy("id").collect()
    narrow = df.select("id", "customer").collect()
    assert sum(map(len, paging._packed(iter(narrow), df.select("id", "customer").schema))) < 8 * len(narrow)
