"""One query per operator, each over whole tables.

A query that writes makes its spaces in a new folder below the shared folder of
the session and returns what a reader of the space would see.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from stowage.errors import SpaceNotEmpty
from stowage.functions.names import transform_columns
from stowage.functions.shards import shard_of
from stowage.operators.batches import STATUSES, batch_report, number_batches
from stowage.operators.conditions import Conditions
from stowage.operators.convert import per_record
from stowage.operators.keys import duplicate_keys
from stowage.operators.landing import plan_batches
from stowage.operators.mapping import to_records
from stowage.operators.validate import VIOLATIONS, validate_rows
from stowage.options import WriteOptions
from stowage.sources.files import Scratch, shared_folder
from stowage.sources.partitioner import Partitioner
from stowage.sources.relation import register
from stowage.sources.store import SpaceStore
from stowage.spec import Field, Index, SpaceSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_store(spark: SparkSession) -> SpaceStore:
    return SpaceStore(spark, f"{shared_folder(spark)}/spaces-{uuid.uuid4().hex}")


_LOADED: dict[tuple, str] = {}


def seeded(spark: SparkSession, folder: str, name: str, key: list[str], *indexes: Index) -> SpaceStore:
    """A store holding table ``name`` as a space, for reading.

    Loaded once per application; all queries that only read share it.
    """
    known = (spark.sparkContext.applicationId, folder, name, *key, *indexes)
    if known in _LOADED:
        store = SpaceStore(spark, _LOADED[known])
        if store.exists(name):
            return store
    store = filled(spark, folder, name, key, *indexes)
    _LOADED[known] = store.root
    return store


def filled(spark: SparkSession, folder: str, name: str, key: list[str], *indexes: Index) -> SpaceStore:
    """A new store holding table ``name`` as a space, for writing to."""
    df = table(spark, folder, name)
    store = new_store(spark)
    store.create(name, SpaceSpec.from_schema(df.schema, key, indexes=indexes))
    store.write(df, name, stable_input=True)
    return store


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as the zone-less ones of the tables."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


# Scans


@query
def scan_customer(spark, folder):
    store = seeded(spark, folder, "customer", ["c_custkey"])
    return store.scan("customer")


@query
def scan_partitioned(spark, folder):
    """Ranges of (user, event): how many there are, and how many start before the one ahead ends."""
    store = seeded(spark, folder, "events", ["event_id"])
    ranged = store.scan("events", partitions=8, by=["user_id"])
    place = F.struct("user_id", "event_id")
    ranges = (
        ranged.select("user_id", "event_id", F.spark_partition_id().alias("part"))
        .groupBy("part")
        .agg(F.count("*").alias("n"), F.min(place).alias("low"), F.max(place).alias("high"))
    )
    # One row per range.
    ahead = F.lag("high").over(Window.orderBy("part"))
    return ranges.withColumn("ahead", ahead).agg(
        F.sum("n").alias("n_events"),
        F.count("*").alias("n_ranges"),
        F.count(F.when(F.col("low") <= F.col("ahead"), 1)).alias("n_overlaps"),
    )


@query
def scan_user_schema(spark, folder):
    store = seeded(spark, folder, "orders", ["o_orderkey"])
    schema = T.StructType(
        [
            T.StructField("o_totalprice", T.DecimalType(15, 2)),
            T.StructField("o_orderkey", T.StringType()),
            T.StructField("o_note", T.StringType()),
            T.StructField("o_custkey", T.IntegerType()),
        ]
    )
    return store.scan("orders", schema=schema)


@query
def scan_required_columns(spark, folder):
    store = seeded(spark, folder, "orders", ["o_orderkey"])
    return plain_times(store.scan("orders", required=["o_orderdate", "o_orderkey"]))


@query
def scan_converter(spark, folder):
    store = seeded(spark, folder, "documents", ["doc_id"])

    def headline(batch):
        text = batch["text"]
        first = [None if pd.isna(t) else t.split("\n", 1)[0] for t in text]
        return batch[["doc_id"]].assign(title=first, n_words=text.str.count(" ") + 1)

    return store.scan_as(
        "documents", headline, "doc_id bigint, title string, n_words bigint", columns=["doc_id", "text"]
    )


@query
def scan_converter_factory(spark, folder):
    store = seeded(spark, folder, "documents", ["doc_id"])

    def digit_counter():
        import re

        digit = re.compile("[0-9]")
        return lambda batch: batch[["doc_id"]].assign(n_digits=batch["text"].str.count(digit.pattern))

    return store.scan_with("documents", digit_counter, "doc_id bigint, n_digits bigint", columns=["doc_id", "text"])


@query
def scan_record_converter(spark, folder):
    store = seeded(spark, folder, "supplier", ["s_suppkey"])
    convert = per_record(
        lambda s: {"id": s["s_suppkey"], "label": f"{s['s_name']}/{s['s_nationkey']}"}, columns=["id", "label"]
    )
    return store.scan_as("supplier", convert, "id bigint, label string")


@query
def scan_converter_nulls(spark, folder):
    """A converter adds one to numbers of more bits than a double has; NULL stays NULL."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.expr("CASE WHEN o_orderkey % 3 <> 0 THEN (1L << 60) + o_orderkey END").alias("n")
    )
    store = new_store(spark)
    store.create("orders", SpaceSpec.from_schema(orders.schema, ["o_orderkey"]))
    store.write(orders, "orders")
    return store.scan_as("orders", lambda batch: batch.assign(n=batch["n"] + 1), "o_orderkey bigint, n bigint")


@query
def empty_probe(spark, folder):
    df = table(spark, folder, "orders")
    store = new_store(spark)
    store.create("orders", SpaceSpec.from_schema(df.schema, ["o_orderkey"]))
    steps = []

    def probe(step):
        seen = store.scan("orders").agg(F.count("*").alias("n_rows"))
        steps.append(
            seen.select(F.lit(step).alias("step"), F.lit(store.is_empty("orders")).alias("is_empty"), "n_rows")
        )

    probe("created")
    store.write(df, "orders")
    probe("loaded")
    store.truncate("orders")
    probe("truncated")
    return steps[0].union(steps[1]).union(steps[2])


@query
def schema_discovery(spark, folder):
    """Field, type and number of values for each field of a space."""
    store = seeded(spark, folder, "events", ["event_id"])
    schema = store.schema("events")
    filled = store.scan("events").agg(*[F.count(f.name).alias(f.name) for f in schema.fields])
    types = F.create_map(*[F.lit(x) for f in schema.fields for x in (f.name, f.dataType.simpleString())])
    return filled.unpivot([], schema.names, "field", "n_values").select("field", types[F.col("field")].alias("type"), "n_values")


# Conditions and pages

_BY_CUSTOMER = Index("customer", ("o_custkey",), unique=False)


@query
def cond_any(spark, folder):
    store = seeded(spark, folder, "conversations", ["conv_id", "turn"])
    return store.scan("conversations", conditions=Conditions.any())


@query
def cond_gt(spark, folder):
    store = seeded(spark, folder, "orders", ["o_orderkey"], _BY_CUSTOMER)
    return plain_times(store.scan("orders", conditions=Conditions.index_greater_than("customer", [75])))


@query
def cond_gt_number(spark, folder):
    store = seeded(spark, folder, "orders", ["o_orderkey"], _BY_CUSTOMER)
    return plain_times(store.scan("orders", conditions=Conditions.index_greater_than(0, [700])))


@query
def cond_gt_composite(spark, folder):
    store = seeded(spark, folder, "conversations", ["conv_id", "turn"])
    return store.scan("conversations", conditions=Conditions.index_greater_than("primary", [4, 2]))


@query
def cond_limit(spark, folder):
    store = seeded(spark, folder, "orders", ["o_orderkey"], _BY_CUSTOMER)
    first = Conditions.index_greater_than("customer", [20]).with_limit(100)
    return plain_times(store.scan("orders", conditions=first))


@query
def page_orders(spark, folder):
    store = seeded(spark, folder, "orders", ["o_orderkey"])
    page = Conditions.index_greater_than("primary", [100]).with_limit(50).start_after([120])
    return plain_times(store.scan("orders", conditions=page))


@query
def page_follow(spark, folder):
    """Two pages by a non-unique index; the second starts where the first ended."""
    store = seeded(spark, folder, "orders", ["o_orderkey"], _BY_CUSTOMER)
    first, last = store.page("orders", index="customer", size=40)
    second, _ = store.page("orders", index="customer", after=last, size=40)
    pages = first.withColumn("page", F.lit(0)).union(second.withColumn("page", F.lit(1)))
    return pages.select("page", "o_custkey", "o_orderkey")


@query
def page_by_time(spark, folder):
    """The fourth to sixth page of the events by time, each one started from the position of the one before."""
    store = seeded(spark, folder, "events", ["event_id"], Index("time", ("ts",), unique=False))
    after, pages = None, []
    for number in range(6):
        page, after = store.page("events", index="time", after=after, size=60)
        pages.append(page.select("event_id", "ts", F.lit(number).alias("page")))
    found = pages[3]
    for page in pages[4:]:
        found = found.union(page)
    return plain_times(found)


@query
def index_order(spark, folder):
    """Places of the rows of a limited scan by a secondary index, in the order in which they come."""
    store = seeded(spark, folder, "orders", ["o_orderkey"], _BY_CUSTOMER)
    conditions = Conditions.index_greater_than("customer", [40]).start_after({"o_custkey": 45, "o_orderkey": 0}).with_limit(150)
    rows = store.scan("orders", conditions=conditions).select("o_custkey", "o_orderkey").coalesce(1)
    listed = rows.agg(F.collect_list(F.struct("o_custkey", "o_orderkey")).alias("rows"))
    return listed.select(F.posexplode("rows").alias("place", "row")).select("place", "row.*")


@query
def page_walk(spark, folder):
    store = seeded(spark, folder, "events", ["event_id"], Index("user", ("user_id",), unique=False))
    return store.pages("events", index="user", size=1000, columns=["event_id"])


# Names and mapping

_MIXED = {
    "o_orderkey": "orderKey",
    "o_custkey": "custKEYNumber",
    "o_orderstatus": "Order_Status",
    "o_totalprice": "totalPrice",
    "o_orderdate": "_orderDate",
    "o_orderpriority": "order1Priority",
}


def _mixed_orders(spark, folder):
    return table(spark, folder, "orders").withColumnsRenamed(_MIXED)


@query
def names_none(spark, folder):
    return transform_columns(_mixed_orders(spark, folder), "none")


@query
def names_lower(spark, folder):
    return transform_columns(_mixed_orders(spark, folder), "lower_case")


@query
def names_upper(spark, folder):
    return transform_columns(_mixed_orders(spark, folder), "upper_case")


@query
def names_snake(spark, folder):
    """Loaded through the transform into a space with snake_case fields."""
    spec = SpaceSpec(
        (
            Field("order_key", "unsigned"),
            Field("cust_key_number", "unsigned"),
            Field("order_status", "string"),
            Field("total_price", "number"),
            Field("_order_date", "datetime"),
            Field("order1priority", "string"),
        ),
        (Index("primary", ("order_key",)),),
    )
    store = new_store(spark)
    store.create("orders", spec)
    store.write(_mixed_orders(spark, folder), "orders", transform_field_names="snake_case")
    return plain_times(store.scan("orders"))


_PART_SPEC = SpaceSpec(
    (
        Field("p_partkey", "unsigned"),
        Field("p_name", "string"),
        Field("p_size", "integer", True),
        Field("p_comment", "string", True),
        Field("p_retailprice", "number", True),
    ),
    (Index("primary", ("p_partkey",)),),
)


@query
def records_by_name(spark, folder):
    shuffled = table(spark, folder, "part").select("p_retailprice", "p_name", "p_size", "p_partkey")
    return to_records(shuffled, _PART_SPEC)


@query
def records_by_position(spark, folder):
    unnamed = table(spark, folder, "part").select("p_partkey", "p_brand", "p_size").toDF("a", "b", "c")
    return to_records(unnamed, _PART_SPEC, by="position")


@query
def normalise_array(spark, folder):
    store = seeded(spark, folder, "embeddings", ["vec_id"])
    placed = store.scan("embeddings").select("vec_id", F.posexplode("embedding").alias("place", "text"))
    return placed.select("vec_id", "place", F.col("text").cast("float").cast("double").alias("value"))


@query
def normalise_map(spark, folder):
    spec = SpaceSpec((Field("event_id", "unsigned"), Field("props", "map")), (Index("primary", ("event_id",)),))
    store = new_store(spark)
    store.create("events", spec)
    store.write(table(spark, folder, "events").select("event_id", "props"), "events")
    return store.scan("events").select("event_id", F.size("props").alias("n_props"), F.col("props")["k"].alias("k"))


@query
def normalise_nested(spark, folder):
    """Conversations as arrays of maps, stored with their structure: turns come back as maps, their words as arrays."""
    turn = F.struct("turn", "role", "text")
    turns = table(spark, folder, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    words = F.transform("turns", lambda t: F.struct(F.split(t["text"], " ").alias("words")))
    spec = SpaceSpec(
        (Field("conv_id", "unsigned"), Field("turns", "array<map<string>>"), Field("words", "array<map<array<string>>>")),
        (Index("primary", ("conv_id",)),),
    )
    store = new_store(spark)
    store.create("talks", spec)
    store.write(turns.withColumn("words", words), "talks", "overwrite")
    talks = store.scan("talks").select("conv_id", "words", F.posexplode("turns").alias("place", "said"))
    return talks.select(
        "conv_id",
        "place",
        F.col("said")["turn"].alias("turn"),
        F.col("said")["role"].alias("role"),
        F.col("said")["text"].alias("text"),
        F.size(F.get("words", F.col("place"))["words"]).alias("n_words"),
    )


@query
def normalise_scalars(spark, folder):
    spec = SpaceSpec(
        (
            Field("l_orderkey", "string"),
            Field("l_linenumber", "unsigned"),
            Field("l_quantity", "integer"),
            Field("l_extendedprice", "decimal"),
            Field("l_discount", "number"),
            Field("l_shipdate", "datetime"),
        ),
        (Index("primary", ("l_orderkey",)),),
    )
    lines = table(spark, folder, "lineitem").select(*spec.names)
    stored = plain_times(to_records(lines, spec))
    return stored.withColumn("l_extendedprice", F.col("l_extendedprice").cast("decimal(15,2)"))


# Writes


def _returned_orders(spark, folder):
    """Orders with a returned line, marked so, and a copy of finished ones under new keys."""
    orders = table(spark, folder, "orders")
    returned = table(spark, folder, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    marked = orders.join(returned, "o_orderkey", "left_semi").withColumn("o_orderstatus", F.lit("R"))
    copies = orders.where("o_orderstatus = 'F'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return marked.unionByName(copies)


@query
def append_upsert(spark, folder):
    store = filled(spark, folder, "orders", ["o_orderkey"])
    store.write(_returned_orders(spark, folder), "orders", "append")
    return plain_times(store.scan("orders"))


@query
def replace_many(spark, folder):
    """The same load twice leaves the space as one load does."""
    store = filled(spark, folder, "orders", ["o_orderkey"])
    for _ in range(2):
        store.replace_many(_returned_orders(spark, folder), "orders")
    return store.scan("orders").groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"))


@query
def overwrite_replace(spark, folder):
    orders = table(spark, folder, "orders")
    store = filled(spark, folder, "orders", ["o_orderkey"])
    store.write(orders.where("o_orderstatus <> 'O'"), "orders", "overwrite")
    return plain_times(store.scan("orders"))


@query
def error_if_exists(spark, folder):
    """Three tries: on an empty space, on a filled one, on a truncated one."""
    df = table(spark, folder, "orders")
    store = new_store(spark)
    store.create("orders", SpaceSpec.from_schema(df.schema, ["o_orderkey"]))
    tries = []
    for number in (1, 2, 3):
        if number == 3:
            store.truncate("orders")
        try:
            store.write(df.withColumn("o_orderpriority", F.lit(f"load {number}")), "orders", "errorifexists")
            outcome = "written"
        except SpaceNotEmpty:
            outcome = "already exists"
        seen = store.scan("orders").agg(F.max("o_orderpriority").alias("priority"), F.count("*").alias("n_rows"))
        tries.append(seen.select(F.lit(number).alias("try"), F.lit(outcome).alias("outcome"), "priority", "n_rows"))
    return tries[0].union(tries[1]).union(tries[2])


@query
def ignore_mode(spark, folder):
    df = table(spark, folder, "orders")
    store = new_store(spark)
    store.create("orders", SpaceSpec.from_schema(df.schema, ["o_orderkey"]))
    for number in (1, 2):
        store.write(df.withColumn("o_orderpriority", F.lit(f"load {number}")), "orders", "ignore")
    return plain_times(store.scan("orders"))


@query
def truncate_space(spark, folder):
    """Truncated, then filled with rows of other keys: nothing of the old ones is left."""
    orders = table(spark, folder, "orders")
    store = filled(spark, folder, "orders", ["o_orderkey"])
    store.truncate("orders")
    store.write(orders.withColumn("o_orderkey", F.col("o_orderkey") * 2 + 1), "orders", "append")
    return plain_times(store.scan("orders"))


_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]


@query
def last_wins(spark, folder):
    lines = table(spark, folder, "lineitem")
    store = new_store(spark)
    store.create("lineitem", SpaceSpec.from_schema(lines.schema, ["l_orderkey", "l_linenumber"]))
    store.write(lines, "lineitem", order_by=_LINE_ORDER)
    return plain_times(store.scan("lineitem"))


@query
def last_wins_hot_keys(spark, folder):
    """A handful of keys share all lines."""
    lines = table(spark, folder, "lineitem")
    store = new_store(spark)
    store.create("lineitem", SpaceSpec.from_schema(lines.schema, ["l_returnflag", "l_linestatus"]))
    store.write(lines, "lineitem", order_by=[*_LINE_ORDER, "l_orderkey", "l_linenumber"])
    return plain_times(store.scan("lineitem"))


@query
def insert_strict(spark, folder):
    """Orders of a space that lacks the open ones: only those are inserted."""
    df = table(spark, folder, "orders")
    store = new_store(spark)
    store.create("orders", SpaceSpec.from_schema(df.schema, ["o_orderkey"]))
    store.write(df.where("o_orderstatus <> 'O'"), "orders")
    again = df.withColumn("o_orderpriority", F.lit("inserted"))
    store.insert_many(again, "orders", stop_on_error=False, rollback_on_error=False, on_error="report")
    return plain_times(store.scan("orders"))


@query
def insert_strict_rollback(spark, folder):
    """As insert_strict, in batches that are undone per shard around each refused row."""
    df = table(spark, folder, "orders")
    store = new_store(spark)
    store.create("orders", SpaceSpec.from_schema(df.schema, ["o_orderkey"], shards=4))
    store.write(df.where("o_totalprice > 450000"), "orders")
    again = df.withColumn("o_orderpriority", F.lit("inserted"))
    store.insert_many(
        again,
        "orders",
        order_by=["o_orderkey"],
        write_part="o_orderstatus",
        batch_size=20,
        stop_on_error=False,
        rollback_on_error=True,
        on_error="report",
    )
    return store.scan("orders").select("o_orderkey", "o_orderpriority")


@query
def insert_into(spark, folder):
    df = table(spark, folder, "customer")
    store = new_store(spark)
    store.create("customer", SpaceSpec.from_schema(df.schema, ["c_custkey"]))
    store.insert(df, "customer")
    try:
        store.insert(df.withColumn("c_name", F.lit("lost")), "customer")
    except SpaceNotEmpty:
        store.insert(df.withColumn("c_name", F.upper("c_name")), "customer", overwrite=True)
    return store.scan("customer")


# Batches

_EVENT_SPEC = SpaceSpec(
    (
        Field("event_id", "unsigned"),
        Field("ts", "datetime"),
        Field("user_id", "unsigned"),
        Field("event_type", "string"),
        Field("value", "number"),
        Field("props", "string", True),
        Field("seq", "unsigned", True),
        Field("part", "string", True),
    ),
    (Index("primary", ("event_id",)),),
    shards=4,
)
_EVENT_LOAD = {"batch_size": 25, "write_part": "part", "order_by": ["ts", "seq"]}


def _damaged_events(spark, folder):
    """Events of which the largest lost their key and the smallest their type."""
    events = table(spark, folder, "events")
    return events.select(
        F.when(F.col("value") <= 300, F.col("event_id")).alias("event_id"),
        "ts",
        "user_id",
        F.when(F.col("value") >= 0.2, F.col("event_type")).alias("event_type"),
        "value",
        "props",
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("part"),
    )


def _planned(spark, folder, stop, rollback):
    planned = plan_batches(
        _damaged_events(spark, folder),
        _EVENT_SPEC,
        Scratch(spark),
        stop_on_error=stop,
        rollback_on_error=rollback,
        **_EVENT_LOAD,
    )
    return planned.select("seq", "write_part", "batch", "shard", "status")


@query
def batch_numbers(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "ts")
    numbered = number_batches(events, 100, "event_id", Scratch(spark), "event_type", ["ts"])
    return numbered.select("event_id", "write_part", "batch")


@query
def batch_stop(spark, folder):
    return _planned(spark, folder, True, True)


@query
def batch_continue(spark, folder):
    return _planned(spark, folder, False, True)


@query
def batch_stop_no_rollback(spark, folder):
    return _planned(spark, folder, True, False)


@query
def batch_no_rollback(spark, folder):
    return _planned(spark, folder, False, False)


@query
def batch_counts(spark, folder):
    return batch_report(_planned(spark, folder, True, True))


def _loaded(spark, folder, stop, rollback):
    store = new_store(spark)
    store.create("events", _EVENT_SPEC)
    report = store.write(
        _damaged_events(spark, folder),
        "events",
        on_error="report",
        stop_on_error=stop,
        rollback_on_error=rollback,
        **_EVENT_LOAD,
    )
    return store, report


@query
def write_stop(spark, folder):
    store, _ = _loaded(spark, folder, True, True)
    return plain_times(store.scan("events"))


@query
def write_continue(spark, folder):
    store, _ = _loaded(spark, folder, False, True)
    return plain_times(store.scan("events"))


@query
def write_report(spark, folder):
    """All batches of a load, with the totals and the reasons of the load beside them."""
    store, report = _loaded(spark, folder, False, True)
    totals = [F.lit(report.rows[s]).cast("bigint").alias(f"all_{s}") for s in STATUSES]
    reasons = "; ".join(f"{reason}: {rows}" for reason, rows in report.reasons)
    return report.batches.select("*", *totals, F.lit(reasons).alias("reasons"))


@query
def validate_events(spark, folder):
    checked = validate_rows(_damaged_events(spark, folder), _EVENT_SPEC)
    return checked.select("seq", F.array_join(VIOLATIONS, "; ").alias("violations"))


@query
def validate_types(spark, folder):
    """Texts that should be numbers, and numbers with a fraction or below zero that should not be."""
    spec = SpaceSpec(
        (Field("c_custkey", "unsigned"), Field("c_acctbal", "unsigned"), Field("c_name", "integer", True)),
        (Index("primary", ("c_custkey",)),),
    )
    rounded = F.when(F.col("c_acctbal") < 1000, F.floor("c_acctbal")).otherwise(F.col("c_acctbal"))
    customers = table(spark, folder, "customer").select("c_custkey", rounded.alias("c_acctbal"), "c_name")
    checked = validate_rows(customers, spec)
    return checked.select("c_custkey", F.array_join(VIOLATIONS, "; ").alias("violations"))


# Shards, unique keys, sources, options


@query
def shard_ids(spark, folder):
    """A space fills its bucket field from the key."""
    spec = SpaceSpec(
        (Field("o_orderkey", "unsigned"), Field("bucket_id", "unsigned"), Field("o_custkey", "unsigned")),
        (Index("primary", ("o_orderkey",)), Index("bucket_id", ("bucket_id",), unique=False)),
        bucket_field="bucket_id",
        shards=16,
    )
    store = new_store(spark)
    store.create("orders", spec)
    store.write(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "orders")
    return store.scan("orders")


@query
def shard_composite(spark, folder):
    turns = table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", shard_of([F.col("conv_id"), F.col("turn")], 8).alias("shard"))


# A refusal concerns its row alone.
_ROW_BY_ROW = {"stop_on_error": False, "rollback_on_error": False}


@query
def unique_conflicts(spark, folder):
    return duplicate_keys(table(spark, folder, "part"), ["p_name"], "n_rows")


@query
def unique_index_load(spark, folder):
    """Two loads into a space whose part names are unique; the first claim of a name holds."""
    parts = table(spark, folder, "part")
    store = new_store(spark)
    store.create("part", SpaceSpec.from_schema(parts.schema, ["p_partkey"], indexes=(Index("name", ("p_name",)),)))
    for load in ("p_size > 25", "p_size <= 25"):
        store.write(parts.where(load), "part", order_by=["p_partkey"], on_error="report", **_ROW_BY_ROW)
    return store.scan("part")


@query
def unique_index_replace(spark, folder):
    """Rows of even keys give up their names; the names that are free then go to the first that ask."""
    parts = table(spark, folder, "part")
    store = new_store(spark)
    store.create("part", SpaceSpec.from_schema(parts.schema, ["p_partkey"], indexes=(Index("name", ("p_name",)),)))
    store.write(parts.where("p_size > 25"), "part", order_by=["p_partkey"], on_error="report", **_ROW_BY_ROW)
    name = F.concat(F.lit("renamed "), F.col("p_partkey").cast("string"))
    renamed = parts.where("p_size > 25 AND p_partkey % 2 = 0").withColumn("p_name", name).withColumn("step", F.lit(0))
    asking = parts.where("p_size <= 25").withColumn("step", F.lit(1))
    load = renamed.unionByName(asking)
    store.write(load, "part", order_by=["step", "p_partkey"], on_error="report", **_ROW_BY_ROW)
    return store.scan("part")


@query
def unique_two_indexes(spark, folder):
    """No two parts share a name or a price: a refused part holds neither."""
    parts = table(spark, folder, "part")
    indexes = (Index("name", ("p_name",)), Index("price", ("p_brand", "p_size")))
    store = new_store(spark)
    store.create("part", SpaceSpec.from_schema(parts.schema, ["p_partkey"], indexes=indexes))
    store.write(parts, "part", order_by=["p_partkey"], on_error="report", **_ROW_BY_ROW)
    return store.scan("part")


def _unique_batches(spark, folder, **settings):
    parts = table(spark, folder, "part")
    store = new_store(spark)
    spec = SpaceSpec.from_schema(parts.schema, ["p_partkey"], indexes=(Index("name", ("p_name",)),), shards=1)
    store.create("part", spec)
    ordered = {"order_by": ["p_partkey"], "write_part": "_one", "on_error": "report"}
    store.write(parts.withColumn("_one", F.lit(1)), "part", batch_size=7, **ordered, **settings)
    return store.scan("part")


@query
def unique_stop(spark, folder):
    """The batch of the first refused name is the last one that is written."""
    return _unique_batches(spark, folder, stop_on_error=True, rollback_on_error=False)


@query
def unique_rollback(spark, folder):
    """A batch with a refused name is undone, and its names are free for later ones."""
    return _unique_batches(spark, folder, stop_on_error=False, rollback_on_error=True)


@query
def insert_strict_after_rollback(spark, folder):
    """Orders whose first copy was undone with its batch are inserted by a second copy; no other key comes twice."""
    orders = table(spark, folder, "orders")
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    # batches of four per customer; some hold an order that lacks its status
    first = orders.withColumn("place", place).withColumn("broken", F.col("place") % 8 == 3)
    batch = Window.partitionBy("o_custkey", F.expr("(place - 1) div 4"))
    first = first.withColumn("undone", F.max("broken").over(batch))
    again = first.where("undone").withColumn("o_orderpriority", F.lit("second")).withColumn("copy", F.lit(2))
    first = first.withColumn("o_orderstatus", F.when(~F.col("broken"), F.col("o_orderstatus")))
    load = first.withColumn("copy", F.lit(1)).unionByName(again)
    # the second copies come in parts, hence in batches, of their own
    part = F.col("o_custkey") * 2 + F.col("copy")
    store = new_store(spark)
    fields = [Field("o_orderkey", "integer"), Field("o_orderstatus", "string"), Field("o_orderpriority", "string")]
    store.create("orders", SpaceSpec(tuple(fields), (Index("primary", ("o_orderkey",)),), shards=1))
    columns = [f.name for f in fields]
    store.insert_many(
        load.select(*columns, "copy", "place", part.alias("part")),
        "orders",
        order_by=["copy", "place"],
        write_part="part",
        batch_size=4,
        stop_on_error=False,
        rollback_on_error=True,
        on_error="report",
    )
    return store.scan("orders")


def _registered(spark, folder, name, key):
    """A space holding a table, in a store that the data source knows."""
    df = table(spark, folder, name)
    store = new_store(spark)
    store.create(name, SpaceSpec.from_schema(df.schema, key))
    store.write(df, name, "overwrite")
    register(spark, store.root)
    return spark.read.format("stowage")


class _EarlyAlone(Partitioner):
    """The first hundred keys alone, then a tenth of the rest, then all others."""

    def bounds(self, store, space, conditions):
        last = store.scan(space).agg(F.max("o_orderkey")).first()[0]
        return [(100,), (100 + (last - 100) // 10,)]


@query
def scan_partitioner(spark, folder):
    """Orders laid out by a caller's uneven split, with the partition that each came to lie in."""
    df = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    store = new_store(spark)
    store.create("orders", SpaceSpec.from_schema(df.schema, ["o_orderkey"]))
    store.write(df, "orders", "overwrite")
    laid = store.scan("orders", partitioner=_EarlyAlone())
    return laid.withColumn("part", F.spark_partition_id())


@query
def limit_half(spark, folder):
    """The first half of the line items by key, found by counting ranges."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").distinct()
    lines = lines.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"))
    store = new_store(spark)
    store.create("lineitem", SpaceSpec.from_schema(lines.schema, ["l_orderkey", "l_linenumber"]))
    store.write(lines, "lineitem", "overwrite")
    half = store.scan("lineitem").count() // 2
    return store.scan("lineitem", conditions=Conditions(index=0).with_limit(half))


@query
def page_stream(spark, folder):
    """The walk over orders by customer, page by page: ends and size of each."""
    df = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    store = new_store(spark)
    store.create("orders", SpaceSpec.from_schema(df.schema, ["o_orderkey"], indexes=(_BY_CUSTOMER,)))
    store.write(df, "orders", "overwrite")
    pages = store.walk("orders", "customer", size=500)
    ends = [(n, len(p), p[0].o_custkey, p[0].o_orderkey, p[-1].o_custkey, p[-1].o_orderkey) for n, p in enumerate(pages)]
    names = ["page", "n_rows", "first_customer", "first_order", "last_customer", "last_order"]
    return spark.createDataFrame(ends, ", ".join(f"{n} bigint" for n in names))


@query
def read_format(spark, folder):
    """Two columns of the later orders, through the data source."""
    orders = _registered(spark, folder, "orders", ["o_orderkey"]).option("space", "orders").load()
    middle = table(spark, folder, "orders").agg(F.max("o_orderkey")).first()[0] // 2
    return orders.where(F.col("o_orderkey") > middle).select("o_orderkey", "o_totalprice")


@query
def read_format_all(spark, folder):
    """Every event with its times and texts, through the data source."""
    return plain_times(_registered(spark, folder, "events", ["event_id"]).load(space="events"))


@query
def read_format_precedence(spark, folder):
    """Of two spaces named, the call's comes before the session's, and its short name before the long one."""
    spark.conf.set("spark.stowage.space", "nobody")
    try:
        reader = _registered(spark, folder, "customer", ["c_custkey"])
    finally:
        spark.conf.unset("spark.stowage.space")
    reader = reader.option("spark.stowage.space", "nothing").option("stowage.space", "customer")
    return reader.option("columns", "c_custkey, c_name").load()


@query
def load_from_sql(spark, folder):
    for name in ("customer", "nation", "region"):
        table(spark, folder, name).createOrReplaceTempView(f"stowage_{name}")
    df = spark.sql(
        """SELECT c.c_custkey AS custKey, c.c_name AS custName, n.n_name AS nationName, r.r_name AS regionName
           FROM stowage_customer c
           JOIN stowage_nation n ON c.c_nationkey = n.n_nationkey
           JOIN stowage_region r ON n.n_regionkey = r.r_regionkey"""
    )
    spec = SpaceSpec(
        (
            Field("cust_key", "unsigned"),
            Field("cust_name", "string"),
            Field("region_name", "string"),
            Field("nation_name", "string"),
        ),
        (Index("primary", ("cust_key",)),),
    )
    store = new_store(spark)
    store.create("customer", spec)
    store.write(df, "customer", options={"stowage.transformFieldNames": "snake_case"})
    return store.scan("customer")


@query
def load_from_orc(spark, folder):
    """Decimals of both kinds from an ORC table, with the bucket left to the space."""
    orders = table(spark, folder, "orders").select(
        F.lit(None).cast("int").alias("bucket_id"),
        (F.col("o_orderkey").cast("decimal(19,0)") + F.lit("0.271828182845904523").cast("decimal(18,18)")).alias("amount"),
        (F.col("o_totalprice") * 100).cast("decimal(38,0)").alias("serial"),
    )
    name = f"stowage_orc_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    orders.write.format("orc").option("path", path).saveAsTable(name)
    spec = SpaceSpec(
        (Field("bucket_id", "unsigned"), Field("amount", "decimal"), Field("serial", "decimal", True)),
        (Index("amount", ("amount",)), Index("bucket_id", ("bucket_id",), unique=False)),
        bucket_field="bucket_id",
    )
    store = new_store(spark)
    store.create("ledger", spec)
    store.write(spark.table(name), "ledger", "overwrite", batch_size=9)
    spark.sql(f"DROP TABLE {name}")
    return store.scan("ledger").select("amount", "serial", F.col("bucket_id").isNotNull().alias("has_bucket"))


@query
def option_precedence(spark, folder):
    """Batches of the events under the batch size each source of options gives."""
    events = table(spark, folder, "events").select("event_id")
    scratch = Scratch(spark)
    counts = []

    def count(source, options):
        size = WriteOptions.resolve(spark, options, space="events").batch_size
        batches = number_batches(events, size, "event_id", scratch, order_by=["event_id"])
        counts.append(
            batches.agg((F.max("batch") + 1).alias("n_batches")).select(
                F.lit(source).alias("source"), F.lit(size).cast("bigint").alias("batch_size"), "n_batches"
            )
        )

    count("default", None)
    spark.conf.set("spark.stowage.batchSize", "40")
    count("session, long name", None)
    spark.conf.set("stowage.batchSize", "20")
    count("session", None)
    count("call, long name", {"spark.stowage.batchSize": "15"})
    count("call", {"stowage.batchSize": "10", "spark.stowage.batchSize": "15"})
    spark.conf.unset("stowage.batchSize")
    spark.conf.unset("spark.stowage.batchSize")
    result = counts[0]
    for one in counts[1:]:
        result = result.union(one)
    return result
