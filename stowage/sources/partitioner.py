"""How the rows of a scan are dealt to tasks, by an object of the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stowage.operators.conditions import Conditions, after_key
from stowage.spec import SpaceSpec


class Partitioner:
    """Gives the bounds between ranges of an index; each range becomes one task.

    Subclasses override :meth:`bounds`. This one puts everything in one range.
    """

    index: str | int = 0

    def bounds(self, store, space: str, conditions: Conditions) -> Sequence[tuple]:
        """Upper ends, in order, of all ranges but the last: values of the index's fields, or of the first ones.

        A row whose fields equal an end, as far as it goes, belongs to the range that ends there.
        """
        return []


def lay_out(df: DataFrame, spec: SpaceSpec, partitioner: Partitioner, bounds: Sequence[tuple]) -> DataFrame:
    """Rows in as many partitions as there are ranges, in their order; rows of a range stay together."""
    fields = spec.index(partitioner.index).fields
    if wrong := [b for b in bounds if not 0 < len(b) <= len(fields)]:
        raise ValueError(f"ends {wrong} do not fit the fields {list(fields)}")
    # as many comparisons as ranges: a row lies behind every end that it comes after
    place = F.lit(0)
    for end in bounds:
        place = place + after_key([F.col(f) for f in fields[: len(end)]], end).cast("int")
    return df.repartitionById(len(bounds) + 1, F.coalesce(place, F.lit(0)).cast("int"))
