"""Reading a space page by page."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import replace
from datetime import datetime, timedelta, timezone
from functools import partial
from itertools import islice

from pyspark.sql import DataFrame, Row, functions as F, types as T

from stowage.operators.conditions import Conditions, apply_conditions, literal, scan_order, until_key
from stowage.operators.numbering import block_of, number_rows
from stowage.sources.files import Scratch
from stowage.spec import SpaceSpec

#: Rows of a limited scan that one task may order.
SMALL = 10_000
_RANGE_ROWS = 50_000  # of a walk that come to the driver together
_PACK_ROWS = 10_000  # of them that are compressed together


def end_of(df: DataFrame, spec: SpaceSpec, conditions: Conditions) -> Row | None:
    """The last position among the rows that a limited scan returns, found over the ordering fields alone."""
    order = scan_order(spec, conditions.index)
    return _position(apply_conditions(df, spec, conditions), df.schema, order)


def nth_of(df: DataFrame, spec: SpaceSpec, conditions: Conditions, scratch: Scratch) -> Row | None:
    """As :func:`end_of`, for limits of any size: rows are counted by ranges of the ordering fields, so that no task
    sees more than its range.
    """
    order = scan_order(spec, conditions.index)
    rows = apply_conditions(df, spec, replace(conditions, limit=None), ordered=False).select(*order)
    numbered = number_rows(rows, order, scratch, name="_n")
    return _position(numbered.where(F.col("_n") <= conditions.limit), df.schema, order)


def _position(rows: DataFrame, schema: T.StructType, order: list[str]) -> Row | None:
    # Times come to the driver as microseconds: a local time may mean two moments.
    held = [F.unix_micros(f).alias(f) if _is_time(schema, f) else F.col(f) for f in order]
    last = rows.agg(F.max(F.struct(*order)).alias("last")).select("last.*").select(*held).first()
    if last is None or all(v is None for v in last):
        return None if rows.isEmpty() else Row(*order)(*last)
    start = datetime(1970, 1, 1, tzinfo=timezone.utc)
    values = [
        start + timedelta(microseconds=v) if v is not None and _is_time(schema, f) else v for f, v in zip(order, last)
    ]
    return Row(*order)(*values)


def _is_time(schema: T.StructType, name: str) -> bool:
    return isinstance(schema[name].dataType, T.TimestampType)


def up_to(df: DataFrame, spec: SpaceSpec, conditions: Conditions, last: Row) -> DataFrame:
    """The rows of a limited scan whose last position is known: only that stretch is read, and nothing is counted."""
    order = scan_order(spec, conditions.index)
    stretch = df.where(until_key([F.col(f) for f in order], list(last)))
    if spec.required(order[0]):
        stretch = stretch.where(F.col(order[0]) <= literal(last[0]))
    return apply_conditions(stretch, spec, replace(conditions, limit=None))


def _packed(rows: Iterator[Row], schema: T.StructType) -> Iterator[bytes]:
    """The rows of a task, compressed by column: neighbours in order are alike."""
    rows = map(schema.toInternal, rows)
    while part := list(islice(rows, _PACK_ROWS)):
        yield zlib.compress(pickle.dumps([list(values) for values in zip(*part)]))


def walk_pages(df: DataFrame, order: list[str], size: int, rows: int) -> Iterator[list[Row]]:
    """``df`` of at most ``rows`` rows in order, in lists of ``size``; the driver holds two ranges of rows at most."""
    ranges = max(1, -(-rows // _RANGE_ROWS))
    ordered = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    schema = df.schema
    packs = ordered.rdd.mapPartitions(partial(_packed, schema=schema))
    page: list[Row] = []
    for pack in packs.toLocalIterator(prefetchPartitions=True):
        for values in zip(*pickle.loads(zlib.decompress(pack))):
            page.append(schema.fromInternal(values))
            if len(page) == size:
                yield page
                page = []
    if page:
        yield page


def number_pages(df: DataFrame, spec: SpaceSpec, index, size: int, scratch: Scratch, page: str = "page") -> DataFrame:
    """All rows with the 0-based page each one falls on; one pass for all pages."""
    numbered = number_rows(df, scan_order(spec, index), scratch, name="_n")
    return numbered.withColumn(page, block_of(F.col("_n") - F.lit(1), size)).select(*df.columns, page)
