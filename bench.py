"""Headline operations, timed: prints one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Each operation is run once to
warm up and then ``$BENCH_RUNS`` times; the median counts. Writes go to the
shared folder of the session.
"""

from __future__ import annotations

import itertools
import json
import os
import statistics
import time

from pyspark.sql import SparkSession, functions as F

from stowage import Conditions, Index, SpaceSpec
from stowage.operators.landing import plan_batches
from stowage.plans import queries as q
from stowage.sources.files import Scratch

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def consume(df):
    """Compute every column of every row and keep none."""
    df.write.format("noop").mode("overwrite").save()


def operations(spark):
    orders = q.table(spark, FOLDER, "orders")
    lines = q.table(spark, FOLDER, "lineitem")
    spec = SpaceSpec.from_schema(
        orders.schema, ["o_orderkey"], indexes=(Index("customer", ("o_custkey",), unique=False),)
    )
    filled = q.new_store(spark)
    filled.create("orders", spec)
    filled.write(orders, "orders")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    # A tenth of the keys, spread over all of them.
    some = orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(10)) == 0).withColumn("o_orderstatus", F.lit("X"))

    def store_of(mode_rows):
        store = q.new_store(spark)
        store.create("orders", spec)
        if mode_rows:
            store.write(orders, "orders")
        return store

    def upsert(delta, stable=True):
        store = store_of(True)
        return lambda: store.write(delta, "orders", stable_input=stable)

    def append_new():
        store, turns = store_of(True), itertools.count(1)

        def run():  # other keys at each run
            store.write(some.withColumn("o_orderkey", F.col("o_orderkey") + next(turns) * (last + 1)), "orders", stable_input=True)

        return run

    def pages():
        consume(filled.pages("orders", "customer", 1000))
        filled.release()

    def planned():
        scratch = Scratch(spark)
        consume(plan_batches(q._damaged_events(spark, FOLDER), q._EVENT_SPEC, scratch, **q._EVENT_LOAD))
        scratch.remove()

    def last_wins():
        store = q.new_store(spark)
        store.create("lineitem", SpaceSpec.from_schema(lines.schema, ["l_orderkey", "l_linenumber"]))
        return lambda: store.write(lines, "lineitem", "overwrite", order_by=q._LINE_ORDER)

    middle = Conditions.index_greater_than("primary", [last // 2]).with_limit(1000)
    overwritten = store_of(False)
    return {
        "scan_full": lambda: consume(filled.scan("orders")),
        "scan_two_columns": lambda: consume(filled.scan("orders", required=["o_orderkey", "o_totalprice"])),
        "scan_condition": lambda: consume(
            filled.scan("orders", conditions=Conditions.index_greater_than("customer", [5000]), ordered=False)
        ),
        "page_by_key": lambda: consume(filled.scan("orders", conditions=middle)),
        "page_by_index": lambda: consume(filled.page("orders", "customer", {"o_custkey": 5000, "o_orderkey": 0})[0]),
        "pages_all": pages,
        "overwrite": lambda: overwritten.write(orders, "orders", "overwrite", stable_input=True),
        "upsert_tenth": upsert(some),
        "upsert_unstable_input": upsert(some, False),
        "append_new_keys": append_new(),
        "last_wins_lineitem": last_wins(),
        "batch_outcome_events": planned,
        "load_with_errors": lambda: q._loaded(spark, FOLDER, False, True),
        "unique_index_load": lambda: consume(q.unique_index_load(spark, FOLDER)),
        "strict_insert": lambda: consume(q.insert_strict(spark, FOLDER)),
    }


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, run in operations(spark).items():
        run()
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "total of median seconds per operation",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
