"""Records to rows on a read, rows to records on a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stowage.functions.names import transformed_names
from stowage.functions.types import coerce, normalise, spark_type
from stowage.spec import SpaceSpec


def column(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def to_rows(df: DataFrame, schema: T.StructType, required: Sequence[str] | None = None) -> DataFrame:
    """Read records by field name as ``schema``.

    A field the records lack becomes NULL, a record field outside ``schema`` is
    dropped. ``required`` picks output columns, in its order.
    """
    wanted = {f.name: f for f in schema.fields}
    names = list(wanted) if required is None else list(required)
    if unknown := [n for n in names if n not in wanted]:
        raise ValueError(f"required columns {unknown} are not in the schema")
    present = set(df.columns)
    return df.select(
        [
            (coerce(column(n), wanted[n].dataType) if n in present else F.lit(None).cast(wanted[n].dataType)).alias(n)
            for n in names
        ]
    )


def record_sources(
    df: DataFrame,
    spec: SpaceSpec,
    transform: str = "none",
    by: str = "name",
    ignore: Sequence[str] = (),
) -> dict[str, T.StructField | None]:
    """For each field of the space, the column of ``df`` that feeds it, if any.

    By name, columns may come in any order; a column that is no field is an
    error unless listed in ``ignore``. By position, the i-th column feeds the
    i-th field and transforms do not apply.
    """
    columns = {f.name: f for f in df.schema.fields}
    if len(columns) != len(df.columns):
        raise ValueError("column names of a load must be distinct")
    if by == "position":
        if len(columns) > len(spec.fields):
            raise ValueError(f"{len(columns)} columns for {len(spec.fields)} fields")
        fed = dict(zip(spec.names, columns.values()))
    elif by == "name":
        renamed = transformed_names([c for c in columns if c not in ignore], transform)
        fed = {new: columns[old] for old, new in renamed.items()}
        if unknown := sorted(set(fed) - set(spec.names)):
            raise ValueError(f"columns {unknown} are not fields of the space")
    else:
        raise ValueError(f"rows are read by name or by position, not by {by!r}")
    return {name: fed.get(name) for name in spec.names}


def record_values(spec: SpaceSpec, sources: dict[str, T.StructField | None]) -> dict[str, Column]:
    """Stored value of each field; NULL where the source value does not fit its type."""
    values = {}
    for field in spec.fields:
        source = sources[field.name]
        if source is None:
            values[field.name] = F.lit(None).cast(spark_type(field.type))
        else:
            values[field.name] = normalise(column(source.name), source.dataType, field.type)
    return values


def to_records(df: DataFrame, spec: SpaceSpec, transform: str = "none", by: str = "name") -> DataFrame:
    """Rows as records of the space: its fields, order and types."""
    values = record_values(spec, record_sources(df, spec, transform, by))
    return df.select([values[n].alias(n) for n in spec.names])
