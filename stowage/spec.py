"""Declared format of a space: fields, indexes and sharding."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import types as T

from stowage.functions.types import spark_type


# Names of the columns that a load adds to its records.
_RESERVED = re.compile(r"_seq|_file|_key|_values|_reason|_problems|_part|_order\d+")


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = False

    def __post_init__(self):
        spark_type(self.type)


@dataclass(frozen=True)
class Index:
    """An ordering over fields. The first index of a space is its primary key."""

    name: str
    fields: tuple[str, ...]
    unique: bool = True

    def __post_init__(self):
        object.__setattr__(self, "fields", tuple(self.fields))


@dataclass(frozen=True)
class SpaceSpec:
    """What a space holds.

    ``shards`` is the number of shards that ``bucket_field`` (when there is one)
    is filled with. ``max_loads`` is how many loads a space may consist of
    before a load writes the smaller half of them anew together with its rows.
    """

    fields: tuple[Field, ...]
    indexes: tuple[Index, ...]
    bucket_field: str | None = None
    shards: int = 2
    max_loads: int = 16

    def __post_init__(self):
        object.__setattr__(self, "fields", tuple(self.fields))
        object.__setattr__(self, "indexes", tuple(self.indexes))
        names = self.names
        if len({n.lower() for n in names}) != len(names):
            raise ValueError("field names must be distinct, case aside")
        if bad := [n for n in names if _RESERVED.fullmatch(n) or "." in n or "`" in n]:
            raise ValueError(f"field names {bad} are reserved or hold a dot or a backtick")
        if not self.indexes or not self.indexes[0].unique:
            raise ValueError("the first index must be the unique primary key")
        known = set(names)
        for index in self.indexes:
            if missing := [f for f in index.fields if f not in known]:
                raise ValueError(f"index {index.name!r} uses unknown fields {missing}")
            if unordered := [f for f in index.fields if _unordered(spark_type(self.field(f).type))]:
                raise ValueError(f"index {index.name!r} uses fields {unordered}, which have no order")
        if self.bucket_field is not None and self.bucket_field not in known:
            raise ValueError(f"unknown bucket field {self.bucket_field!r}")
        if self.shards < 1 or self.max_loads < 1:
            raise ValueError("shards and max_loads must be positive")

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    @property
    def primary_key(self) -> tuple[str, ...]:
        return self.indexes[0].fields

    @property
    def unique_keys(self) -> list[Index]:
        """Unique indexes other than the primary key."""
        return [i for i in self.indexes[1:] if i.unique]

    def index(self, which: str | int | Sequence[str]) -> Index:
        """Look an index up by name, by number, or by its list of fields."""
        if isinstance(which, bool):
            raise TypeError("an index is named by text, number or fields")
        if isinstance(which, int):
            if not 0 <= which < len(self.indexes):
                raise LookupError(f"no index number {which}")
            return self.indexes[which]
        for index in self.indexes:
            if index.name == which or (not isinstance(which, str) and index.fields == tuple(which)):
                return index
        raise LookupError(f"no index {which!r}; known: {[i.name for i in self.indexes]}")

    def required(self, name: str) -> bool:
        """Whether a row without this field is refused."""
        if name == self.bucket_field:
            return False
        if name in self.primary_key:
            return True
        return not self.field(name).nullable

    def schema(self) -> T.StructType:
        """Spark schema of a scan; every field is nullable there."""
        return T.StructType([T.StructField(f.name, spark_type(f.type), True) for f in self.fields])

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=1)

    @classmethod
    def from_json(cls, text: str) -> SpaceSpec:
        raw = json.loads(text)
        raw["fields"] = [Field(**f) for f in raw["fields"]]
        raw["indexes"] = [Index(**i) for i in raw["indexes"]]
        return cls(**raw)

    @classmethod
    def from_schema(cls, schema: T.StructType, primary_key: Sequence[str], **settings) -> SpaceSpec:
        """A spec for data that already has a Spark schema; ``nested=True`` keeps what maps and arrays hold."""
        nested = settings.pop("nested", False)
        fields = [Field(f.name, format_type(f.dataType, nested), f.name not in primary_key) for f in schema.fields]
        indexes = [Index("primary", tuple(primary_key)), *settings.pop("indexes", ())]
        return cls(tuple(fields), tuple(indexes), **settings)


def _unordered(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _unordered(data_type.elementType)
    return isinstance(data_type, T.MapType)


def format_type(data_type: T.DataType, nested: bool = False) -> str:
    """Format type that keeps values of a Spark type; of ``nested`` ones, what they hold as well, not its text.

    Fields of a struct become values of a map. If they have one type it is that of the map, else it is text.
    """
    if nested and isinstance(data_type, T.ArrayType):
        return f"array<{format_type(data_type.elementType, True)}>"
    if nested and isinstance(data_type, T.MapType):
        return f"map<{format_type(data_type.valueType, True)}>"
    if nested and isinstance(data_type, T.StructType):
        held = {format_type(f.dataType, True) for f in data_type}
        return f"map<{held.pop() if len(held) == 1 else 'string'}>"
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(data_type, T.DecimalType):
        return "decimal"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.ArrayType):
        return "array"
    if isinstance(data_type, (T.MapType, T.StructType)):
        return "map"
    if isinstance(data_type, T.StringType):
        return "string"
    raise ValueError(f"no field type for {data_type.simpleString()}")
