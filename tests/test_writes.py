import itertools
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spaces import VESSELS, harbour, ids, vessels
from stowage import ConcurrentWrite, Field, Index, SpaceNotEmpty, SpaceSpec, SpaceStore, SpaceWriteError
from stowage.operators.landing import Landing
from stowage.sources import store as store_module

def parcels(spark, depot):
    """Seven parcels under names in camel case; keys 100 to 106."""
    return spark.range(100, 107).select(
        F.col("id").cast("int").alias("parcelNo"),
        F.lit(depot).alias("depotName"),
        (F.col("id") / 8).cast("decimal(12,3)").alias("grossWeight"),
        F.array(F.col("id") % 3, F.lit(None).cast("bigint")).alias("itemCodes"),
        F.create_map(F.lit("zone"), (F.col("id") % 2).cast("string")).alias("labels"),
        (F.col("id") % 2 == 0).alias("sealed"),
    )


PARCELS = SpaceSpec(
    (
        Field("parcel_no", "unsigned"),
        Field("depot_name", "string"),
        Field("gross_weight", "number"),
        Field("item_codes", "array"),
        Field("labels", "map"),
        Field("sealed", "boolean"),
    ),
    (Index("parcel_no", ("parcel_no",)),),
)


def test_modes(spark, store):
    store.create("parcels", PARCELS)

    def depots(mode, depot):
        store.write(parcels(spark, depot), "parcels", mode, {"stowage.transformFieldNames": "snake_case"})
        found = store.scan("parcels").groupBy("depot_name").count().collect()
        assert sum(r["count"] for r in found) == 7
        return {r.depot_name for r in found}

    assert depots("ignore", "Oslo") == {"Oslo"}  # the space is empty
    assert depots("append", "Turku") == {"Turku"}  # replaced by key
    assert depots("ignore", "Riga") == {"Turku"}
    assert depots("overwrite", "Riga") == {"Riga"}
    with pytest.raises(SpaceNotEmpty, match="already exists"):
        depots("errorifexists", "Kiel")
    store.truncate("parcels")
    assert depots("errorifexists", "Kiel") == {"Kiel"}
    with pytest.raises(ValueError, match="unknown mode"):
        depots("merge", "Bremen")
    row = store.scan("parcels").where("parcel_no = 103").first()
    assert (row.gross_weight, row.item_codes, row.labels, row.sealed) == (12.875, ["1", None], {"zone": "1"}, False)


def test_missing_field_is_refused(spark, store):
    store.create("vessels", VESSELS)
    df = vessels(spark).drop("flag")
    with pytest.raises(SpaceWriteError, match=r"field 4 \(flag\): expected string, got nil \(3\)"):
        store.write(df, "vessels")
    assert store.is_empty("vessels")


@pytest.mark.parametrize("transform", ["upper_case", "none"])
def test_name_mapping(spark, store, transform):
    fields = tuple(Field(n.upper() if transform == "upper_case" else n, "string") for n in ("code", "colour"))
    store.create("t", SpaceSpec(fields, (Index("pk", (fields[0].name,)),)))
    df = spark.createDataFrame([("red", "x1"), ("blue", "x2")], "colour string, code string")
    store.write(df, "t", transform_field_names=transform)
    assert {tuple(r) for r in store.scan("t").collect()} == {("x1", "red"), ("x2", "blue")}


def with_a_hole(spark):
    """Five vessels, the second and fourth without a key or a name."""
    rows = [(21, "Far Shore", "NO"), (None, "Drifter", "NO"), (23, "Tern", "IS"), (24, None, "IS"), (25, "Skua", "FO")]
    df = spark.createDataFrame(rows, "imo int, name string, flag string").coalesce(1)
    return df.withColumn("tonnes", F.lit(1.5))


def test_stop_on_error(spark, store):
    harbour(store)
    options = {"stowage.stopOnError": "true", "stowage.rollbackOnError": "true", "stowage.batchSize": "2"}
    with pytest.raises(SpaceWriteError, match="left rows out") as caught:
        store.write(with_a_hole(spark), "vessels", "overwrite", options)
    # the refused row has no key, hence no shard: nothing is undone with it
    assert ids(store.scan("vessels")) == [21]
    report = caught.value.report
    # a row that cannot be written anywhere is counted as such, also after the stop
    assert report.rows == {"written": 1, "rejected": 2, "rolled_back": 0, "skipped": 2}
    assert [tuple(r) for r in report.batches.orderBy("batch").collect()] == [
        (0, 0, 2, 1, 1, 0, 0),
        (0, 1, 2, 0, 1, 0, 1),
        (0, 2, 1, 0, 0, 0, 1),
    ]


def test_continue_on_error(spark, store):
    harbour(store)
    with pytest.raises(SpaceWriteError):
        store.write(with_a_hole(spark), "vessels", "overwrite", stop_on_error=False, batch_size=1)
    assert ids(store.scan("vessels")) == [21, 23, 25]


def test_reports_hold_every_reason_and_batch(spark, store):
    store.create("vessels", VESSELS)
    df = with_a_hole(spark).withColumn("tonnes", F.when(F.col("flag") != "FO", F.col("tonnes")))
    report = store.write(df, "vessels", on_error="report", stop_on_error=False, rollback_on_error=False, batch_size=3)
    assert report.failed and report.rows["rejected"] == 3
    assert report.reasons == [
        ("field 1 (imo): expected unsigned, got nil", 1),
        ("field 2 (name): expected string, got nil", 1),
        ("field 5 (tonnes): expected number, got nil", 1),
    ]
    assert all(reason in report.message for reason, _ in report.reasons)
    assert sorted((r.batch, r.expected, r.rejected) for r in report.batches.collect()) == [(0, 3, 1), (1, 2, 2)]
    fine = store.write(vessels(spark), "vessels", on_error="report", batch_size=2)
    assert not fine.failed and fine.reasons == []
    assert sorted((r.batch, r.expected, r.written) for r in fine.batches.collect()) == [(0, 2, 2), (1, 1, 1)]
    with pytest.raises(ValueError, match="on_error"):
        store.write(vessels(spark), "vessels", on_error="ignore")


# Stop, rollback -> written, rejected, rolled back, skipped, of the
# events of sf0.01 with every 997th key and every 1009th type removed.
OUTCOMES = {
    (True, True): (2166, 20, 30, 7784),
    (False, True): (9928, 20, 52, 0),
    (True, False): (2196, 20, 0, 7784),
    (False, False): (9980, 20, 0, 0),
}


@pytest.mark.parametrize("stop,rollback", OUTCOMES)
def test_batch_outcome(spark, store, stop, rollback):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    damaged = events.select(
        F.expr("CASE WHEN event_id % 997 <> 900 THEN event_id END").alias("event_id"),
        F.expr("CASE WHEN event_id % 1009 <> 600 THEN event_type END").alias("event_type"),
        F.col("event_id").alias("seq"),
        (F.col("event_id") % 4).alias("part"),
    )
    spec = SpaceSpec(
        (Field("event_id", "unsigned"), Field("event_type", "string")), (Index("id", ("event_id",)),), shards=4
    )
    store.create("events", spec)
    report = store.write(
        damaged.repartition(7), "events", order_by=["seq"], write_part="part", batch_size=25,
        stop_on_error=stop, rollback_on_error=rollback, on_error="report",
    )
    assert tuple(report.rows.values()) == OUTCOMES[stop, rollback]
    assert sum(report.rows.values()) == 10000
    assert store.scan("events").count() == report.rows["written"]


@pytest.mark.parametrize("stop,batch", list(itertools.product([False, True], [1, 49, 50, 51])))
def test_long_decimals_from_a_table(spark, store, tmp_path, stop, batch):
    """Fifty numbers with all 38 digits in use, and integers wider than 64 bits."""
    rows = [(Decimal(7**22 + i) + Decimal(i + 1).scaleb(-18), Decimal(3**38 + i)) for i in range(50)]
    df = spark.createDataFrame(rows, "amount decimal(38,18), serial decimal(38,0)")
    store.create("ledger", SpaceSpec.from_schema(df.schema, ["amount"]))
    spark.sql("DROP TABLE IF EXISTS ledger")
    df.write.format("orc").option("path", str(tmp_path / "orc")).saveAsTable("ledger")
    store.write(spark.table("ledger"), "ledger", "overwrite", stop_on_error=stop, batch_size=batch)
    spark.sql("DROP TABLE ledger")
    assert sorted((r.amount, r.serial) for r in store.scan("ledger").collect()) == rows


def test_last_row_of_a_key_wins(spark, store):
    store.create("orders", SpaceSpec.from_schema(spark.createDataFrame([], "id int, v int").schema, ["id"]))
    df = spark.createDataFrame([(1, 10), (2, 20), (1, 11), (1, 12), (2, 21)], "id int, v int").coalesce(1)
    report = store.write(df, "orders")
    assert report.superseded == 3
    assert {tuple(r) for r in store.scan("orders").collect()} == {(1, 12), (2, 21)}
    store.write(df, "orders", order_by=["v"])
    assert {tuple(r) for r in store.scan("orders").collect()} == {(1, 12), (2, 21)}
    store.write(df.withColumn("o", -F.col("v")), "orders", order_by=["o"])
    assert {tuple(r) for r in store.scan("orders").collect()} == {(1, 10), (2, 20)}


def test_random_loads_match_a_dictionary(spark, store):
    """Loads of every size against a plain dictionary; keys stay unique throughout."""
    random.seed(7)
    schema = "k string, n int, v int"
    store.create("t", SpaceSpec.from_schema(spark.createDataFrame([], schema).schema, ["k", "n"], max_loads=3))
    expected = {}
    for load in range(6):
        size = random.choice([1, 3, 40, 200])
        hot = load % 2
        rows = [
            ("hot" if hot and random.random() < 0.4 else random.choice("abcdef"), random.randint(0, 1 if hot else 60), i)
            for i in range(size)
        ]
        store.write(spark.createDataFrame(rows, schema), "t", order_by=["v"])
        expected.update({(k, n): v for k, n, v in rows})
        got = store.scan("t").collect()
        assert len(got) == len(expected)
        assert {(r.k, r.n): r.v for r in got} == expected


@pytest.mark.parametrize("key", ["decimal(38,18)", "timestamp", "string", "double"])
def test_keys_of_every_type(spark, store, key):
    rows = spark.range(60).select(
        F.when(F.lit(key == "timestamp"), F.timestamp_seconds(F.col("id") * 1800).cast("string"))
        .otherwise((F.col("id") * 1.5).cast("string"))
        .cast(key)
        .alias("k"),
        F.lit(1).alias("v"),
        "id",
    )
    store.create("t", SpaceSpec.from_schema(rows.drop("id").schema, ["k"]))
    store.write(rows.where("id < 40").drop("id"), "t")
    store.write(rows.where("id >= 20").withColumn("v", F.lit(2)).drop("id"), "t")
    got = {r.v: r["count"] for r in store.scan("t").groupBy("v").count().collect()}
    assert got == {1: 20, 2: 40}
    page, last = store.page("t", size=25)
    assert page.count() == 25 and store.page("t", after=last, size=100)[0].count() == 35


def shuffled(spark, partitions, action):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        return action()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_upsert_rewrites_the_files_it_must(store, spark, orders):
    store.create("orders", SpaceSpec.from_schema(orders.schema, ["o_orderkey"]))
    shuffled(spark, 12, lambda: store.write(orders, "orders"))
    space = store._space("orders")
    before = space.current()
    keys = [r[0] for r in orders.select("o_orderkey").orderBy("o_orderkey").collect()]
    some = [*keys[:10], *keys[-10:]]  # the first and the last file
    store.write(orders.where(F.col("o_orderkey").isin(some)).withColumn("o_orderstatus", F.lit("X")), "orders")
    after = space.current()
    gone = [f for f in before.files if f not in after.files]
    assert len(before.files) == 12 and len(gone) == 2
    assert sorted(r[0] for r in store.scan("orders").where("o_orderstatus = 'X'").select("o_orderkey").collect()) == some
    # New keys only: files are added, none is rewritten.
    store.write(orders.withColumn("o_orderkey", F.col("o_orderkey") + 10**6), "orders")
    assert set(after.files) <= set(space.current().files)
    assert store.scan("orders").count() == 2 * orders.count()
    # A vacuum deletes the two files and keeps their neighbours.
    store.vacuum("orders")
    assert store.scan("orders").count() == 2 * orders.count()


def test_many_small_loads_are_written_anew(store, spark):
    store.create("t", SpaceSpec.from_schema(spark.createDataFrame([], "id int").schema, ["id"], max_loads=4))
    for i in range(14):
        store.write(spark.createDataFrame([(i,)], "id int"), "t")
        assert len(store._space("t").current().loads()) <= 4
    assert ids(store.scan("t"), "id") == list(range(14))


def test_large_replacement_without_broadcast(spark, store, orders):
    store.create("orders", SpaceSpec.from_schema(orders.schema, ["o_orderkey"]))
    store.write(orders, "orders")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store.write(orders.where("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("X")), "orders")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {r.o_orderstatus: r["count"] for r in store.scan("orders").groupBy("o_orderstatus").count().collect()}
    assert got == {
        "X" if r.o_orderstatus == "F" else r.o_orderstatus: r["count"]
        for r in orders.groupBy("o_orderstatus").count().collect()
    }


def test_stable_input(store, orders, monkeypatch):
    store.create("orders", SpaceSpec.from_schema(orders.schema, ["o_orderkey"]))
    made = []
    write = Landing.write

    def noted(landing):
        made.append(landing)
        write(landing)

    monkeypatch.setattr(Landing, "write", noted)
    store.write(orders, "orders", stable_input=True)
    store.write(orders.withColumn("o_orderstatus", F.lit("X")), "orders", stable_input=True)
    assert not made
    store.write(orders.unionByName(orders.withColumn("o_orderstatus", F.lit("Y"))), "orders", stable_input=True)
    assert made
    assert {r[0] for r in store.scan("orders").select("o_orderstatus").distinct().collect()} == {"Y"}
    assert store.scan("orders").count() == orders.count()


def test_loading_a_space_from_itself(store):
    harbour(store)
    store.write(store.scan("vessels").withColumn("tonnes", F.col("tonnes") + 1), "vessels", "overwrite")
    assert ids(store.scan("vessels"), "tonnes") == [121.0, 901.5, 4401.25]


def test_a_scan_keeps_its_version(store):
    harbour(store)
    before = store.scan("vessels")
    store.truncate("vessels")
    assert before.count() == 3 and store.is_empty("vessels")
    store.write(vessels(store.spark), "vessels")
    store.vacuum("vessels")
    assert ids(store.scan("vessels")) == [11, 12, 13]


def test_failed_jobs_change_nothing(spark, store):
    harbour(store)
    broken = vessels(spark).withColumn("tonnes", F.expr("CAST(raise_error('broken') AS double)"))
    with pytest.raises(Exception, match="broken"):
        store.write(broken, "vessels", "overwrite")
    assert ids(store.scan("vessels")) == [11, 12, 13]


def test_two_writers(store):
    harbour(store)
    space = store._space("vessels")
    base = space.current()
    store.truncate("vessels")
    with pytest.raises(ConcurrentWrite):
        space.add(base, None, base.files)
    assert store.is_empty("vessels")


def test_a_space_filled_meanwhile_is_not_overwritten(spark, store, monkeypatch):
    """Two stores load an empty space at once: the version that was found empty is the one that is built on."""
    store.create("vessels", VESSELS)
    other = SpaceStore(spark, store.root)
    land = store_module.land

    def late(*given, **named):
        monkeypatch.setattr(store_module, "land", land)
        other.write(vessels(spark), "vessels")
        return land(*given, **named)

    monkeypatch.setattr(store_module, "land", late)
    with pytest.raises(ConcurrentWrite):
        store.write(vessels(spark).limit(1), "vessels", "errorifexists")
    assert ids(store.scan("vessels")) == [11, 12, 13]


KEYED = SpaceSpec((Field("id", "unsigned"), Field("v", "string")), (Index("id", ("id",)),), shards=1)


def strict(store, rows, **settings):
    df = store.spark.createDataFrame(rows, "id int, v string").coalesce(1)
    report = store.insert_many(df, "t", on_error="report", **settings)
    return report, {r.id: r.v for r in store.scan("t").collect()}


def test_strict_insert(spark, store):
    store.create("t", KEYED)
    store.write(spark.createDataFrame([(5, "old")], "id int, v string"), "t")
    each = {"stop_on_error": False, "batch_size": 1}
    report, got = strict(store, [(5, "again"), (6, "new"), (6, "twice")], **each)
    assert report.rows == {"written": 1, "rejected": 2, "rolled_back": 0, "skipped": 0}
    assert report.reasons == [("its key is in the space or came earlier in the load", 2)]
    assert got == {5: "old", 6: "new"}
    with pytest.raises(SpaceWriteError, match="came earlier"):
        store.insert_many(spark.createDataFrame([(6, "x")], "id int, v string"), "t")
    # A bad row alone says nothing about keys.
    report, got = strict(store, [(7, "seven"), (8, None)], **each)
    assert [reason for reason, _ in report.reasons] == ["field 2 (v): expected string, got nil"] and 7 in got


def test_strict_insert_of_a_key_that_was_undone(spark, store):
    store.create("t", KEYED)
    settings = {"stop_on_error": False, "rollback_on_error": True, "batch_size": 2}
    report, got = strict(store, [(1, "x"), (2, None), (1, "y")], **settings)
    assert got == {1: "y"}
    assert report.rows == {"written": 1, "rejected": 1, "rolled_back": 1, "skipped": 0}
    # Within a batch the second copy is refused although both are undone.
    report, got = strict(store, [(3, "a"), (3, "b"), (3, "c")], **settings)
    assert report.rows == {"written": 1, "rejected": 1, "rolled_back": 1, "skipped": 0} and got[3] == "c"


def test_insert_into(spark, store):
    store.create("vessels", VESSELS)
    store.insert(vessels(spark), "vessels")
    with pytest.raises(SpaceNotEmpty):
        store.insert(vessels(spark), "vessels")
    store.insert(vessels(spark).where("imo = 11"), "vessels", overwrite=True)
    assert ids(store.scan("vessels")) == [11]


def test_shards(spark, store):
    harbour(store)
    assert {r.berth_shard for r in store.scan("vessels").collect()} <= {1, 2, 3}
    store.write(vessels(spark).withColumn("berth_shard", F.lit(7)), "vessels")
    assert {r.berth_shard for r in store.scan("vessels").collect()} == {7}


UNIQUE = SpaceSpec(
    (Field("id", "unsigned"), Field("u", "string", True), Field("w", "string", True)),
    (Index("id", ("id",)), Index("u", ("u",)), Index("w", ("w",))),
    shards=1,
)


EACH = {"stop_on_error": False, "rollback_on_error": False}


def unique_load(store, rows, **settings):
    df = store.spark.createDataFrame(rows, "id int, u string, w string").coalesce(1)
    report = store.write(df, "t", on_error="report", **(settings or EACH))
    return report, {r.id: (r.u, r.w) for r in store.scan("t").collect()}


def plain_load(space, rows, batch_size=1000, stop_on_error=False, rollback_on_error=False):
    """What a load of one part into one shard does, row by row, on a dictionary. Returns the space and the counts."""
    counts = {"written": 0, "rejected": 0, "rolled_back": 0, "skipped": 0}
    for at in range(0, len(rows), batch_size):
        before, taken, bad = dict(space), 0, 0
        for key, *values in rows[at : at + batch_size]:
            held = any(v is not None and space[k][i] == v for k in space if k != key for i, v in enumerate(values))
            if held:
                bad += 1
            else:
                space[key] = tuple(values)
                taken += 1
        counts["rejected"] += bad
        if bad and rollback_on_error:
            space = before
            counts["rolled_back"] += taken
        else:
            counts["written"] += taken
        if bad and stop_on_error:
            counts["skipped"] += max(0, len(rows) - at - batch_size)
            break
    return space, counts


def test_unique_indexes(store):
    store.create("t", UNIQUE)
    _, got = unique_load(store, [(1, "a", None), (2, "b", None), (3, "a", None), (4, None, None)])
    assert got == {1: ("a", None), 2: ("b", None), 4: (None, None)}
    # A value that a replaced row gives up may be taken by another.
    report, got = unique_load(store, [(1, "c", None), (5, "a", None)])
    assert got[1] == ("c", None) and got[5] == ("a", None) and not report.failed
    # A held value may not; the old row of the refused one stays, and so does what it holds.
    report, got = unique_load(store, [(2, "c", None), (6, "b", None), (7, "d", "y")])
    assert report.unique_conflicts == 2 and report.rows["written"] == 1
    assert got[2] == ("b", None) and 6 not in got and got[7] == ("d", "y")


def test_a_refused_row_holds_nothing(store):
    store.create("t", UNIQUE)
    unique_load(store, [(9, "z", "y")])
    report, got = unique_load(store, [(1, "x", "y"), (2, "x", None)])
    assert report.rows["rejected"] == 1 and got == {9: ("z", "y"), 2: ("x", None)}
    assert report.reasons == [("another key holds its value of unique index 'w'", 1)]
    # Of one key, the last row that was taken in stays.
    report, got = unique_load(store, [(1, "a", None), (1, "z", None)])
    assert got[1] == ("a", None) and report.rows["written"] == 1 and report.superseded == 0


def test_a_chain_of_values(store):
    """Each key takes what the next one gives up; the rounds don't follow the chain."""
    store.create("t", UNIQUE)
    size = 40
    unique_load(store, [(i, f"u{i}", None) for i in range(size)])
    report, got = unique_load(store, [(i, f"u{i + 1}", None) for i in reversed(range(size))])
    assert not report.failed and got == {i: (f"u{i + 1}", None) for i in range(size)}
    report, got = unique_load(store, [(i, f"u{i + 2}", None) for i in range(size)])
    assert report.rows["rejected"] == size - 1 and got[size - 1] == (f"u{size + 1}", None)


@pytest.mark.parametrize("stop,rollback", [(False, False), (True, False), (False, True), (True, True)])
def test_unique_indexes_at_random(spark, store, stop, rollback):
    random.seed(11)
    store.create("t", UNIQUE)
    expected = {}
    for _ in range(2):
        rows = [
            (random.randint(1, 15), random.choice([None, *"abcdefgh"]), random.choice([None, None, *"mnopq"]))
            for _ in range(20)
        ]
        settings = {"batch_size": 4, "stop_on_error": stop, "rollback_on_error": rollback}
        report, got = unique_load(store, rows, **settings)
        expected, counts = plain_load(expected, rows, **settings)
        assert got == expected
        assert report.rows == counts


def test_a_chain_of_undone_batches(store):
    """Each batch asks for a value of the one before: what becomes of it hangs on the whole chain."""
    store.create("t", UNIQUE)
    rows = [(2 * i + j, f"u{i + j}", None) for i in range(40) for j in range(2)]
    settings = {"batch_size": 2, "stop_on_error": False, "rollback_on_error": True}
    report, got = unique_load(store, rows, **settings)
    expected, counts = plain_load({}, rows, **settings)
    assert got == expected and report.rows == counts
    assert counts["written"] == 40


def test_a_chain_of_a_thousand_batches_is_one_round(store):
    """Each batch waits for one other, so outcomes are composed along the chain; one crowded value takes two rounds."""
    store.create("t", UNIQUE)
    rows = [(2 * i + j, f"u{i + j}", None) for i in range(1000) for j in range(2)]
    settings = {"batch_size": 2, "stop_on_error": False, "rollback_on_error": True}
    report, got = unique_load(store, rows, **settings)
    expected = {row[0]: row[1:] for i in range(0, 1000, 2) for row in rows[2 * i : 2 * i + 2]}
    assert got == expected and report.rounds == 1
    crowd = [(10_000 + i, "one" if i % 2 else f"own {i}", None) for i in range(500)]
    report, got = unique_load(store, crowd, **settings)
    assert report.rows["written"] == 2 and report.rounds <= 3


def test_rounds_with_many_crossing_values(store):
    """Random rows over few values of two indexes, keys that come again, against a plain loop."""
    draw = random.Random(4)
    store.create("t", UNIQUE)
    rows = [(draw.randint(1, 160), f"u{draw.randint(1, 30)}", f"w{draw.randint(1, 40)}") for _ in range(250)]
    report, got = unique_load(store, rows)
    expected, counts = plain_load({}, rows)
    assert got == expected and report.rows == counts
    assert report.rounds < 20


def test_batches_that_are_sure_to_be_undone_hold_up_nothing(store):
    """Two batches with a bad row ask for a value before the one that gets it; reasons are those of the turn."""
    store.create("t", UNIQUE)
    rows = [(1, "a", None), (-1, "x", None), (2, "a", None), (-2, "y", None), (3, "a", "m"), (4, "b", None), (5, "a", "m")]
    report, got = unique_load(store, rows, batch_size=2, stop_on_error=False, rollback_on_error=True)
    assert got == {3: ("a", "m"), 4: ("b", None)} and report.rounds == 1
    assert report.rows == {"written": 2, "rejected": 3, "rolled_back": 2, "skipped": 0}
    assert ("another key holds its value of unique index 'u'", 1) in report.reasons


def test_batches_that_interleave_are_taken_whole(spark, store):
    """Two parts in turn: the batch of the earlier first row comes first, also for the last row of a key."""
    store.create("t", UNIQUE)
    rows = [(1, "a", 0, 0), (2, "b", 1, 1), (3, "b", 2, 0), (4, "a", 3, 1), (5, "d", 4, 2), (6, "e", 5, 3), (6, "f", 6, 2)]
    df = spark.createDataFrame(rows, "id int, u string, place int, part int")
    settings = {"batch_size": 2, "stop_on_error": False, "rollback_on_error": True}
    report = store.write(df, "t", order_by=["place"], write_part="part", on_error="report", **settings)
    assert {r.id: r.u for r in store.scan("t").collect()} == {1: "a", 3: "b", 5: "d", 6: "e"}
    assert report.rows == {"written": 5, "rejected": 2, "rolled_back": 0, "skipped": 0}


def test_unknown_columns_and_steering_columns(spark, store):
    store.create("vessels", VESSELS)
    extra = vessels(spark).withColumn("colour", F.lit("red"))
    with pytest.raises(ValueError, match="colour"):
        store.write(extra, "vessels")
    store.write(extra, "vessels", order_by=["imo"], write_part="colour")
    assert store.scan("vessels").count() == 3
    with pytest.raises(ValueError, match="lacks columns"):
        store.write(vessels(spark), "vessels", order_by=["nothing"])


def test_create_twice(store):
    store.create("vessels", VESSELS)
    store.create("vessels", VESSELS, if_not_exists=True)
    with pytest.raises(ValueError, match="already exists"):
        store.create("vessels", VESSELS)
    with pytest.raises(ValueError, match="dot"):
        store.create(".hidden", VESSELS)


def test_scratch_is_removed(spark, store, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    harbour(store)
    store.write(vessels(spark), "vessels")

    def left():
        folder = os.path.join(store.root, ".scratch")
        return [n for n in os.listdir(folder) if not n.startswith(".")] if os.path.exists(folder) else []

    assert left() == []
    report = store.write(with_a_hole(spark), "vessels", on_error="report")
    assert report.batches.count() and len(left()) == 1
    report.close()
    assert report.batches is None and left() == []
    for _ in range(3):
        assert store.pages("vessels", size=2).count() == store.scan("vessels").count()
    assert len(left()) == 3
    store.release()
    assert left() == []
    assert set(os.listdir(shared)) == before
