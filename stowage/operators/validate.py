"""Checks of single rows against the declared format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stowage.functions.types import spark_type
from stowage.operators.mapping import column, record_sources, record_values
from stowage.spec import SpaceSpec

VIOLATIONS = "violations"
LINE = "\n"


def problem_text(spec: SpaceSpec, sources: dict[str, T.StructField | None], values: dict[str, Column]) -> Column:
    """One line per field of the row that the space would refuse; empty text for a good row.

    ``concat_ws`` skips NULLs and, unlike a filter over an array, stays in
    generated code.
    """
    found = []
    for place, field in enumerate(spec.fields, start=1):
        source, value = sources[field.name], values[field.name]
        says = f"field {place} ({field.name}): expected {field.type.lower()}, got "
        cases = []
        if source is not None and source.dataType != spark_type(field.type):
            misfit = column(source.name).isNotNull() & value.isNull()
            cases.append((misfit, says + source.dataType.simpleString()))
        if spec.required(field.name):
            cases.append((value.isNull(), says + "nil"))
        if field.type.lower() == "unsigned":
            cases.append((value < 0, says + "a negative number"))
        if cases:
            message = F.when(cases[0][0], F.lit(cases[0][1]))
            for condition, text in cases[1:]:
                message = message.when(condition, F.lit(text))
            found.append(message)
    return F.concat_ws(LINE, *found) if found else F.lit("")


def violations(spec: SpaceSpec, sources: dict[str, T.StructField | None], values: dict[str, Column]) -> Column:
    """The lines of :func:`problem_text` as an array."""
    text = problem_text(spec, sources, values)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, LINE))


def validate_rows(df: DataFrame, spec: SpaceSpec, transform: str = "none", by: str = "name") -> DataFrame:
    """``df`` with a ``violations`` column; empty for rows the space would take."""
    sources = record_sources(df, spec, transform, by)
    return df.withColumn(VIOLATIONS, violations(spec, sources, record_values(spec, sources)))
