"""Reading the given tables, mapping texts in Arrow batches, and written intermediate tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stowage.llm.kernels import texts
from stowage.sources.files import Scratch

ID, TEXT = "doc_id", "text"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 256  # texts handed to a Python worker together


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession) -> Scratch:
    """Tables in the folder named by ``spark.checkpoint.dir``; other executors can read them after a loss."""
    return Scratch(spark)


def small_batches(spark: SparkSession) -> None:
    """Texts may be long: hand fewer rows at a time to Python than Spark does by default."""
    if int(spark.conf.get(_BATCH)) > BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def give_back() -> None:
    """Return memory that is free to the system: workers of one executor are used for many tasks in turn."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return None


_TRIM = _trim()


def _mapped(batches: Iterator[pa.RecordBatch], kernel: Callable, fields: list[str]) -> Iterator[pa.RecordBatch]:
    try:
        for batch in batches:
            rows, columns = kernel(texts(batch.column(1)))
            ids = batch.column(0)
            if rows is not None:
                ids = ids.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *columns], fields)
    finally:
        if hasattr(kernel, "close"):
            kernel.close()
        give_back()


def map_texts(
    docs: DataFrame, kernel: Callable, schema: str, id_col: str = ID, text_col: str = TEXT, extra: tuple[str, ...] = ()
) -> DataFrame:
    """One call of ``kernel`` per Arrow batch of texts, next to the identifiers of their rows.

    ``kernel`` gets the texts (nulls as empty) and returns ``(rows, columns)``: the
    index of the text that each result row belongs to (None: one row per text) and
    the result columns. Only the identifier and the text are read from ``docs``.
    """
    small_batches(docs.sparkSession)
    kept = docs.select(F.col(id_col).alias(ID), F.col(text_col).cast("string").alias(TEXT))
    fields = T.StructType([kept.schema[0], *T.StructType.fromDDL(schema)])
    return kept.mapInArrow(partial(_mapped, kernel=kernel, fields=fields.names), fields)


def bound(function: Callable, **fixed) -> Callable:
    """``function`` with some arguments fixed, in the form in which Spark takes functions of groups."""

    def call(*tables):
        try:
            return function(*tables, **fixed)
        finally:
            give_back()

    if function.__code__.co_argcount - len(fixed) == 1:
        return lambda table: call(table)
    return lambda one, other: call(one, other)
