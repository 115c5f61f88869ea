"""Typed scans: records through a function of the caller.

Functions work on whole pandas batches that Arrow hands over. The output schema
plays the part of the target type.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

Converter = Callable[[pd.DataFrame], pd.DataFrame]


def convert(df: DataFrame, converter: Converter, schema: T.StructType | str) -> DataFrame:
    """Map every batch of records."""
    return convert_with(df, lambda: converter, schema)


def convert_with(df: DataFrame, factory: Callable[[], Converter], schema: T.StructType | str) -> DataFrame:
    """Map every batch by a converter that ``factory`` makes once per task.

    The converter gets columns of Arrow types, in which every value is exact and
    NULL is NULL.
    """
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(target)

    def run(batches):
        converter = factory()
        for batch in batches:
            frame = pa.Table.from_batches([batch]).to_pandas(types_mapper=pd.ArrowDtype)
            found = converter(frame)
            table = pa.Table.from_pandas(found[target.names], schema=arrow, preserve_index=False)
            yield from table.to_batches()

    return df.mapInArrow(run, target)


def per_record(function: Callable[[dict], dict], columns: list[str]) -> Converter:
    """A converter from a function of one record, for when there is no batch form: it is called for every record."""

    def run(batch):
        records = [function(r) for r in pa.Table.from_pandas(batch, preserve_index=False).to_pylist()]
        # objects stay as they are: no column of numbers is made of them here
        return pd.DataFrame({c: pd.Series([r[c] for r in records], dtype=object) for c in columns})

    return run
