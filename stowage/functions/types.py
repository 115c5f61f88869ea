"""Format types of a space and the Spark types they are read as."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_TEXT_MAP = T.MapType(T.StringType(), T.StringType(), True)

# The format type names and the Spark type each one is read as.
FORMAT_TYPES: dict[str, T.DataType] = {
    "any": _TEXT_MAP,
    "unsigned": T.LongType(),
    "string": T.StringType(),
    "number": T.DoubleType(),
    "double": T.DoubleType(),
    "integer": T.LongType(),
    "boolean": T.BooleanType(),
    "decimal": T.DecimalType(38, 18),
    "uuid": T.StringType(),
    "datetime": T.TimestampType(),
    "array": T.ArrayType(T.StringType(), True),
    "map": _TEXT_MAP,
}


def inner_type(format_type: str) -> tuple[str, str | None]:
    """A format type without, and the type of its elements or values with, what stands in ``array<...>`` or ``map<...>``."""
    outer, opened, rest = format_type.partition("<")
    outer = outer.strip().lower()
    if not opened:
        return outer, None
    if outer not in ("array", "map") or not rest.rstrip().endswith(">"):
        raise ValueError(f"{format_type!r} is neither array<type> nor map<type>")
    return outer, rest.rstrip()[:-1]


def spark_type(format_type: str) -> T.DataType:
    """Spark type of a format type; the name is matched without regard to case.

    ``array<type>`` and ``map<type>`` (with text as keys) say what they hold, at any depth; plain
    ``array`` and ``map`` hold text.
    """
    outer, inner = inner_type(format_type)
    if inner is not None:
        held = spark_type(inner)
        return T.ArrayType(held, True) if outer == "array" else T.MapType(T.StringType(), held, True)
    try:
        return FORMAT_TYPES[outer]
    except KeyError:
        raise ValueError(f"unknown field type {format_type!r}; known: {', '.join(FORMAT_TYPES)}") from None


def coerce(value: Column, to: T.DataType) -> Column:
    """Cast to ``to``, nested elements included; a malformed value fails the job."""
    return value.cast(to)


def _as_text_map(value: Column, source: T.DataType) -> Column:
    if isinstance(source, T.StringType):
        return F.from_json(value, _TEXT_MAP)
    if isinstance(source, T.StructType):
        return F.from_json(F.to_json(value), _TEXT_MAP)
    return value.try_cast(_TEXT_MAP)


def _nested(value: Column, source: T.DataType, target: T.DataType, inner: str) -> Column:
    """Elements, values and fields one by one as ``inner``, which may be nested itself; NULL where nothing fits."""
    if isinstance(source, T.StringType):
        return F.from_json(value, target)
    if isinstance(target, T.ArrayType):
        if isinstance(source, T.ArrayType):
            return F.transform(value, lambda item: normalise(item, source.elementType, inner))
        return F.lit(None).cast(target)
    if isinstance(source, T.MapType):
        values = F.transform_values(value, lambda _, item: normalise(item, source.valueType, inner))
        if isinstance(source.keyType, T.StringType):
            return values
        return F.map_from_arrays(F.map_keys(values).cast(T.ArrayType(T.StringType())), F.map_values(values))
    if isinstance(source, T.StructType):
        fields = [(F.lit(f.name), normalise(value.getField(f.name), f.dataType, inner)) for f in source]
        return F.when(value.isNotNull(), F.create_map(*[part for field in fields for part in field]))
    return F.lit(None).cast(target)


def _in_utc(local: Column) -> Column:
    """The moment at which clocks in UTC show a time that has no zone; no session setting takes part."""
    minutes = F.unix_date(local.cast("date")).cast("bigint") * 1440 + F.hour(local) * 60 + F.minute(local)
    micros = (F.date_part(F.lit("SECOND"), local) * 1_000_000).cast("bigint")
    return F.timestamp_micros(minutes * 60_000_000 + micros)


def normalise(value: Column, source: T.DataType, format_type: str) -> Column:
    """``value`` as the stored form of ``format_type``; NULL where it cannot be.

    Maps and arrays keep their order and their NULLs, and what lies in them its structure where the
    format type says what it is; else it becomes text. JSON text is accepted for arrays and maps, a struct for maps; a fraction does not fit an
    integer; a time or date without a zone is one in UTC.
    """
    target = spark_type(format_type)
    if source == target:
        return value
    outer, inner = inner_type(format_type)
    if inner is not None:
        return _nested(value, source, target, inner)
    if target == _TEXT_MAP:
        return _as_text_map(value, source)
    if isinstance(target, T.ArrayType) and isinstance(source, T.StringType):
        return F.from_json(value, target)
    if isinstance(target, T.TimestampType) and isinstance(source, (T.TimestampNTZType, T.DateType)):
        return _in_utc(value.cast("timestamp_ntz"))
    stored = value.try_cast(target)
    if isinstance(target, T.LongType) and isinstance(source, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.when(stored == value, stored)
    return stored
