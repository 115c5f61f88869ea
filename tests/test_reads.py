import os
import time
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from spaces import harbour, ids
from stowage import Conditions, Field, Index, SpaceNotFound, SpaceSpec
from stowage.operators.convert import per_record


def test_whole_space(store):
    df = harbour(store).scan("vessels")
    assert ids(df) == [11, 12, 13]
    assert df.schema == store.schema("vessels")
    assert df.where("berth_shard is null or berth_shard not between 1 and 3").isEmpty()


def test_unknown_space(store):
    with pytest.raises(SpaceNotFound):
        store.scan("nothing")


def test_limited_page(store):
    harbour(store)
    page = Conditions.index_greater_than("imo", [10]).with_limit(2).start_after([11])
    assert [r.imo for r in store.scan("vessels", conditions=page).collect()] == [12, 13]
    by_number = Conditions.index_greater_than(0, [11]).with_limit(1)
    assert [r.imo for r in store.scan("vessels", conditions=by_number).collect()] == [12]
    none = Conditions.any().with_limit(0)
    assert store.scan("vessels", conditions=none).isEmpty()


def test_secondary_index(store):
    harbour(store)
    c = Conditions.index_greater_than("by_flag", ["E"])
    assert [r.imo for r in store.scan("vessels", conditions=c).collect()] == [13, 11]
    after = c.start_after({"flag": "FI", "imo": 13})
    assert [r.imo for r in store.scan("vessels", conditions=after).collect()] == [11]
    with pytest.raises(ValueError, match="lacks field"):
        store.scan("vessels", conditions=c.start_after({"flag": "FI"}))
    with pytest.raises(LookupError):
        store.scan("vessels", conditions=Conditions.index_greater_than("nothing", [1]))


def test_user_schema(store):
    harbour(store)
    schema = T.StructType.fromDDL("tonnes string, imo int, captain string")
    row = store.scan("vessels", schema=schema).orderBy("imo").first()
    assert tuple(row) == ("900.5", 11, None)
    assert store.scan("vessels", schema=schema, required=["imo"]).columns == ["imo"]


def test_converters(store):
    harbour(store)

    def labelled(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"imo": batch["imo"], "label": batch["flag"] + "-" + batch["name"]})

    out = store.scan_as("vessels", labelled, "imo bigint, label string")
    assert {r.label for r in out.collect()} == {"NO-Amber Tide", "DK-Quiet Sound", "FI-Long Reach"}
    out = store.scan_with("vessels", lambda: labelled, "imo bigint, label string", Conditions.index_greater_than(0, [12]))
    assert [tuple(r) for r in out.collect()] == [(13, "FI-Long Reach")]
    heavy = per_record(lambda r: {"imo": r["imo"], "heavy": r["tonnes"] > 500}, ["imo", "heavy"])
    assert {r.imo for r in store.scan_as("vessels", heavy, "imo bigint, heavy boolean").collect() if r.heavy} == {11, 13}


def test_converters_get_exact_values_and_nulls(spark, store):
    """One batch with a 64-bit number that no double holds, and a NULL."""
    fields = (Field("k", "unsigned"), Field("n", "unsigned", True), Field("d", "decimal", True), Field("b", "boolean", True))
    store.create("t", SpaceSpec(fields, (Index("k", ("k",)),)))
    exact = Decimal("12345678901234567890.000000000000000001")
    rows = [(1, 2**60 + 1, exact, True), (2, None, None, None)]
    store.write(spark.createDataFrame(rows, "k bigint, n bigint, d decimal(38,18), b boolean").coalesce(1), "t")
    schema = "k bigint, n bigint, d decimal(38,18), b boolean"
    assert sorted(tuple(r) for r in store.scan_as("t", lambda batch: batch, schema).collect()) == rows
    seen = per_record(lambda r: {"k": r["k"], "said": repr((r["n"], r["d"], r["b"]))}, ["k", "said"])
    said = {r.k: r.said for r in store.scan_as("t", seen, "k bigint, said string").collect()}
    assert said == {1: repr((2**60 + 1, exact, True)), 2: "(None, None, None)"}


def test_pages_follow_the_ordered_scan(store, orders):
    by_customer = Index("customer", ("o_custkey",), unique=False)
    store.create("orders", SpaceSpec.from_schema(orders.schema, ["o_orderkey"], indexes=(by_customer,)))
    store.write(orders, "orders")
    expected = [r.o_orderkey for r in orders.orderBy("o_custkey", "o_orderkey").collect()]
    got, after = [], None
    while True:
        page, after = store.page("orders", index="customer", after=after, size=400)
        if after is None:
            assert page.isEmpty()
            break
        got += [r.o_orderkey for r in page.collect()]
    assert got == expected

    numbered = store.pages("orders", index="customer", size=400, columns=["o_orderstatus"])
    assert numbered.columns == ["o_custkey", "o_orderkey", "o_orderstatus", "page"]
    pages = {r.o_orderkey: r.page for r in numbered.collect()}
    assert pages == {key: place // 400 for place, key in enumerate(expected)}


def test_page_size_from_options(store):
    page, last = harbour(store).page("vessels", options={"stowage.cursorBatchSize": "2"})
    assert page.count() == 2 and last.imo == 12


def test_pages_over_a_clock_change(spark, store):
    """Twelve moments around the end of summer time: two of them an hour apart have one local time."""
    zone = os.environ.get("TZ")
    os.environ["TZ"] = "Europe/Berlin"
    time.tzset()
    try:
        fields = (Field("k", "unsigned"), Field("at", "datetime"))
        store.create("t", SpaceSpec(fields, (Index("k", ("k",)), Index("at", ("at",)))))
        start = 1729987200  # 2024-10-27 00:00 UTC, an hour before the change
        rows = spark.range(12).select(F.col("id").alias("k"), F.timestamp_seconds(F.col("id") * 900 + start - 1800).alias("at"))
        store.write(rows, "t")
        got, after = [], None
        for _ in range(8):
            page, after = store.page("t", index="at", after=after, size=2)
            if after is None:
                break
            got.append(sorted(r.k for r in page.select("k").collect()))
        assert got == [[i, i + 1] for i in range(0, 12, 2)]
    finally:
        os.environ.pop("TZ") if zone is None else os.environ.update(TZ=zone)
        time.tzset()


def test_times_without_a_zone_are_utc(spark, store):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.sql(
            "SELECT 1 AS k, timestamp_ntz'2024-03-31 02:30:00' AS at UNION ALL SELECT 2, timestamp_ntz'2024-10-27 02:30:00'"
        )
        store.create("t", SpaceSpec.from_schema(df.schema, ["k"]))
        store.write(df, "t")
        got = {r.k: r.s for r in store.scan("t").select("k", F.unix_seconds("at").alias("s")).collect()}
        assert got == {1: 1711852200, 2: 1729996200}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def files_of(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_a_page_reads_the_files_of_its_stretch(spark, store, orders):
    store.create("orders", SpaceSpec.from_schema(orders.schema, ["o_orderkey"]))
    spark.conf.set("spark.sql.shuffle.partitions", "10")
    try:
        store.write(orders, "orders")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
    files = store._space("orders").current().files
    assert len(files) == 10
    keys = sorted(r[0] for r in orders.select("o_orderkey").collect())
    for conditions in (
        Conditions.any().with_limit(20),
        Conditions.any().with_limit(20).start_after({"o_orderkey": keys[700]}),
        Conditions.index_greater_than(0, [keys[300]]).with_limit(20),
    ):
        page = store.scan("orders", conditions=conditions)
        assert page.count() == 20
        assert len(page.inputFiles()) <= 2
    page, last = store.page("orders", after=[keys[99]], size=100)
    assert [r.o_orderkey for r in page.collect()] == keys[100:200] and last.o_orderkey == keys[199]
    assert len(page.inputFiles()) <= 3
    assert len(store.scan("orders", conditions=Conditions.index_greater_than(0, [keys[-50]])).inputFiles()) == 1


def test_a_frequent_leading_field_is_split(spark, store, lines):
    spec = SpaceSpec.from_schema(lines.schema, ["l_linestatus", "l_orderkey", "l_linenumber"])
    store.create("lines", spec)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        store.write(lines.withColumn("l_linestatus", F.lit("F")), "lines")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
    rows = [f.rows for f in store._space("lines").current().files]
    assert len(rows) == 8 and max(rows) < 0.3 * sum(rows)


def test_a_scan_lists_its_files_once(spark, store, orders):
    store.create("orders", SpaceSpec.from_schema(orders.schema, ["o_orderkey"]))
    store.write(orders, "orders")
    first = store.scan("orders")
    space = store._space("orders")
    assert space.read(space.current()) is space.read(space.current())
    store.write(orders.limit(1), "orders")
    assert first.count() == store.scan("orders").count() == orders.count()


def test_composite_key_with_nulls(spark, store):
    spec = SpaceSpec.from_schema(
        T.StructType.fromDDL("id int, a int, b int"), ["id"], indexes=(Index("ab", ("a", "b"), unique=False),)
    )
    rows = [(1, None, 1), (2, None, None), (3, 1, None), (4, 1, 2), (5, 1, 2), (6, 2, 0)]
    store.create("t", spec)
    store.write(spark.createDataFrame(rows, "id int, a int, b int"), "t")
    order = [2, 1, 3, 4, 5, 6]
    got, after = [], None
    for _ in order:
        page, after = store.page("t", index="ab", after=after, size=1)
        got += [r.id for r in page.collect()]
    assert got == order
    c = Conditions.index_greater_than("ab", [1, 1])
    assert [r.id for r in store.scan("t", conditions=c).collect()] == [4, 5, 6]
    assert [r.id for r in store.scan("t", conditions=Conditions.index_greater_than("ab", [1])).collect()] == [6]


def test_filters_reach_the_scan(spark, store, orders):
    store.create("orders", SpaceSpec.from_schema(orders.schema, ["o_orderkey"]))
    store.write(orders, "orders")
    df = store.scan("orders", conditions=Conditions.index_greater_than(0, [700]).with_limit(5)).select("o_orderkey")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(o_orderkey,700)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert df.count() == 5


def test_partitioned_scan(store, orders):
    store.create("orders", SpaceSpec.from_schema(orders.schema, ["o_orderkey"]))
    store.write(orders, "orders")
    df = store.scan("orders", partitions=5, by=["o_custkey"])
    assert df.rdd.getNumPartitions() == 5
    place = F.struct("o_custkey", "o_orderkey")
    spans = df.groupBy(F.spark_partition_id().alias("p")).agg(F.min(place).alias("a"), F.max(place).alias("b"))
    spans = sorted((tuple(r.a), tuple(r.b)) for r in spans.collect())
    assert len(spans) == 5
    assert all(left[1] < right[0] for left, right in zip(spans, spans[1:]))


def test_partitioned_scan_splits_a_frequent_value(store, orders):
    store.create("orders", SpaceSpec.from_schema(orders.schema, ["o_orderkey"]))
    store.write(orders.withColumn("o_orderstatus", F.lit("F")), "orders")
    sizes = store.scan("orders", partitions=5, by=["o_orderstatus"]).groupBy(F.spark_partition_id()).count()
    assert len([r for r in sizes.collect() if r["count"] > 100]) == 5


def test_emptiness(store):
    harbour(store)
    assert store.non_empty("vessels") and not store.is_empty("vessels")
    store.truncate("vessels")
    assert store.is_empty("vessels")
    assert store.scan("vessels").columns == store.spec("vessels").names
