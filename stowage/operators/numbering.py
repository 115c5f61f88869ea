"""Row numbers over a total order, computed without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stowage.sources.files import Scratch

_PLACE, _CHUNK, _FIRST, _ROWS, _BASE = "_place", "_chunk", "_first", "_rows", "_base"
_POSITION_BITS = 33  # low bits of monotonically_increasing_id()


def input_part(sequence: Column) -> Column:
    """Input partition held in a ``monotonically_increasing_id``."""
    return F.shiftright(sequence, _POSITION_BITS)


def input_position(sequence: Column) -> Column:
    """0-based place within its partition held in a ``monotonically_increasing_id``."""
    return sequence.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))


def block_of(place: Column, size: int) -> Column:
    """0-based block of ``size`` that a 0-based place falls into."""
    return F.call_function("div", place, F.lit(size))


def look_up(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` with the other columns of ``table``, matched on ``keys``; NULL keys match NULL keys."""
    other = table.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    return rows.join(other, condition, how).drop(*[f"_of_{k}" for k in keys])


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    scratch: Scratch,
    part_by: Sequence[str] = (),
    name: str = "row_number",
    chunk: str = _CHUNK,
) -> DataFrame:
    """Add the 1-based place of each row within its part, as ``row_number()`` would.

    ``order_by`` must order the rows of a part totally. Instead of one window
    task per part, rows are range-partitioned by (part, order) so that even a
    part holding most rows is spread over many tasks; each task numbers its own
    range, and the count of the ranges before it is added. Only that table of
    counts, one row per part and range, goes through a window.

    ``chunk`` names an output column with the range a row was in: groups by
    (part, chunk) are never larger than one range.
    """
    keys = [*part_by, *order_by]
    placed = (
        df.repartitionByRange(*[F.col(k) for k in keys])
        .sortWithinPartitions(*keys)
        .withColumn(_PLACE, F.monotonically_increasing_id())
    )
    # Written out: range boundaries are sampled anew on each run, so counts and
    # rows must come from the same run.
    placed = scratch.table(placed, "numbered").withColumn(chunk, input_part(F.col(_PLACE)))

    counts = placed.groupBy(*part_by, chunk).agg(F.min(_PLACE).alias(_FIRST), F.count("*").alias(_ROWS))
    earlier = Window.partitionBy(*part_by).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(_BASE, F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0))).drop(_ROWS)

    number = F.col(_BASE) + F.col(_PLACE) - F.col(_FIRST) + F.lit(1)
    return look_up(placed, counts, [*part_by, chunk]).withColumn(name, number).drop(_PLACE, _FIRST, _BASE)


def last_before(
    df: DataFrame, order_by: Sequence[str], value: str, scratch: Scratch, part_by: Sequence[str], name: str
) -> DataFrame:
    """Add the last ``value`` that is set in a row before each row, within its part; NULL if there is none.

    ``order_by`` must order the rows of a part totally. Rows are spread as in :func:`number_rows`; what
    ranges end with, one row per part and range, goes through a window of its own.
    """
    keys = [*part_by, *order_by]
    placed = (
        df.repartitionByRange(*[F.col(k) for k in keys])
        .sortWithinPartitions(*keys)
        .withColumn(_PLACE, F.monotonically_increasing_id())
    )
    placed = scratch.table(placed, "placed").withColumn(_CHUNK, input_part(F.col(_PLACE)))

    ends = placed.groupBy(*part_by, _CHUNK).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(_PLACE))).alias("_end"))
    earlier = Window.partitionBy(*part_by).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn(_BASE, F.last("_end", ignorenulls=True).over(earlier)).drop("_end")

    within = Window.partitionBy(*part_by, _CHUNK).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.withColumn("_own", F.last(value, ignorenulls=True).over(within))
    rows = look_up(rows, ends, [*part_by, _CHUNK]).withColumn(name, F.coalesce("_own", _BASE))
    return rows.drop(_PLACE, _CHUNK, _BASE, "_own")
