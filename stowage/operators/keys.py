"""Operators on the keys of a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def last_rows(df: DataFrame, key: Sequence[str], order_by: Sequence[str], seq: str) -> DataFrame:
    """The last row of each key in ``order_by``, by ``seq``, which is unique and ends ``order_by``.

    An aggregate over keys and ordering columns alone: copies of a hot key are
    reduced before the shuffle, and wide rows don't take part.
    """
    last = df.groupBy(*key).agg(F.max(F.struct(*dict.fromkeys(order_by))).alias("_last"))
    return last.select(F.col("_last")[seq].alias(seq))


def last_wins(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order_by``, which should be total."""
    order = [c for c in dict.fromkeys(order_by) if c not in key]
    rest = [c for c in df.columns if c not in key and c not in order]
    last = F.max_by(F.struct(*order, *rest), F.struct(*order)) if order else F.any_value(F.struct(*rest))
    found = df.groupBy(*key).agg(last.alias("_last"))
    return found.select(*[F.col(c) if c in key else F.col("_last")[c].alias(c) for c in df.columns])


def repeated_rows(df: DataFrame, key: Sequence[str]) -> int:
    """How many rows share their key with an earlier one."""
    counts = df.groupBy(*key).agg(F.count("*").alias("_n"))
    return counts.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))).first()[0]


def duplicate_keys(df: DataFrame, key: Sequence[str], count: str = "rows") -> DataFrame:
    """Keys held by more than one row, with the number of rows. NULL keys do not count."""
    held = df.where(all_set(key)).groupBy(*key).agg(F.count("*").alias(count))
    return held.where(F.col(count) > 1)


def all_set(names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).isNotNull()
    return condition
