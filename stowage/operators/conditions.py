"""Index conditions compiled to filter, order and limit.

The predicates are plain comparisons on columns, so they reach the Parquet scan
as pushed filters; files are sorted by primary key and skip row groups by them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Row, functions as F

from stowage.spec import SpaceSpec


@dataclass(frozen=True)
class Conditions:
    """Filter, limit and start position of a scan. Immutable."""

    index: str | int | tuple[str, ...] | None = None
    greater_than: tuple | None = None
    limit: int | None = None
    position: object = None

    @staticmethod
    def any() -> Conditions:
        """Every row."""
        return Conditions()

    @staticmethod
    def index_greater_than(index: str | int | Sequence[str], values: Sequence) -> Conditions:
        """Rows whose key in ``index`` is strictly greater than ``values``, in index order.

        ``values`` may be a prefix of the index's fields.
        """
        if not isinstance(index, (str, int)):
            index = tuple(index)
        return Conditions(index=index, greater_than=tuple(values))

    def with_limit(self, rows: int) -> Conditions:
        """At most ``rows`` rows, taken in index order."""
        if rows < 0:
            raise ValueError("the limit must not be negative")
        return replace(self, limit=rows)

    def start_after(self, row: Row | Mapping | Sequence) -> Conditions:
        """Go on strictly after ``row``, which is a record of the space.

        A mapping or ``Row`` is read by field name, a plain sequence by position.
        The index's fields must be there, and the primary key for an index that
        is not unique.
        """
        if isinstance(row, Row):
            row = row.asDict()
        held = tuple(sorted(row.items())) if isinstance(row, Mapping) else tuple(row)
        return replace(self, position=(isinstance(row, Mapping), held))


def literal(value) -> Column:
    """A literal that means the same moment in every zone, if the value is a time with one."""
    if isinstance(value, datetime) and value.tzinfo is not None:
        return F.timestamp_micros(F.lit((value - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)))
    return F.lit(value)


def after_key(columns: Sequence[Column], values: Sequence) -> Column:
    """Columns compare after values, field by field; NULL stands before all values."""
    tail = None
    for column, value in reversed(list(zip(columns, values))):
        greater = column.isNotNull() if value is None else column > literal(value)
        if tail is None:
            tail = greater
        else:
            same = column.isNull() if value is None else column == literal(value)
            tail = greater | (same & tail)
    if len(values) > 1 and values[0] is not None:
        # Implied by the rest; a bare comparison that the scan can use.
        tail = (columns[0] >= literal(values[0])) & tail
    return tail


def until_key(columns: Sequence[Column], values: Sequence) -> Column:
    """Columns compare before values or equal to them; NULL stands before all values."""
    tail = F.lit(True)
    for column, value in reversed(list(zip(columns, values))):
        if value is None:
            tail = column.isNull() & tail
        else:
            tail = column.isNull() | (column < literal(value)) | ((column == literal(value)) & tail)
    return tail


def _position_value(spec: SpaceSpec, position, name: str):
    by_name, held = position
    if by_name:
        record = dict(held)
        if name not in record:
            raise ValueError(f"the start row lacks field {name!r}")
        return record[name]
    place = spec.names.index(name)
    if place >= len(held):
        raise ValueError(f"the start row lacks field {name!r}")
    return held[place]


def position_values(spec: SpaceSpec, conditions: Conditions, order: Sequence[str]) -> list:
    """The start position's values of the ordering fields."""
    return [_position_value(spec, conditions.position, f) for f in order]


def scan_order(spec: SpaceSpec, index) -> list[str]:
    """Fields that order an index totally: its own, then the primary key."""
    chosen = spec.index(0 if index is None else index)
    order = list(chosen.fields)
    nullable = any(not spec.required(f) for f in order)
    if not chosen.unique or nullable:
        order += [f for f in spec.primary_key if f not in order]
    return order


def apply_conditions(df: DataFrame, spec: SpaceSpec, conditions: Conditions, ordered: bool = True) -> DataFrame:
    """Rows of ``df`` that meet ``conditions``.

    With ``ordered=False`` an unlimited scan leaves out the global sort.
    """
    if conditions.greater_than is not None:
        key = spec.index(conditions.index).fields
        values = conditions.greater_than
        if not 0 < len(values) <= len(key):
            raise ValueError(f"index {conditions.index!r} takes 1 to {len(key)} values")
        df = df.where(after_key([F.col(f) for f in key], values))
    order = scan_order(spec, conditions.index)
    if conditions.position is not None:
        last = position_values(spec, conditions, order)
        df = df.where(after_key([F.col(f) for f in order], last))
    if conditions.limit is not None:
        return df.orderBy(*order).limit(conditions.limit)
    if ordered and conditions != Conditions():
        return df.orderBy(*order)
    return df
