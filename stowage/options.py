"""Read and write options and how they are resolved.

A value is looked for, in this order: ``stowage.<name>`` among the options of
the call, ``spark.stowage.<name>`` among them, the same two keys in the session
configuration, the default. Keyword arguments of the store's methods stand above
all of these.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession

from stowage.functions.names import transform_named
from stowage.operators.conditions import Conditions

_PREFIXES = ("stowage.", "spark.stowage.")


def lookup(spark: SparkSession | None, options: Mapping[str, object] | None, name: str):
    """The value of option ``name`` or None."""
    for prefix in _PREFIXES:
        if options and options.get(prefix + name) is not None:
            return options[prefix + name]
    if spark is not None:
        for prefix in _PREFIXES:
            value = spark.conf.get(prefix + name, None)
            if value is not None:
                return value
    return None


def _positive(name, value) -> int:
    number = int(value)
    if number < 1:
        raise ValueError(f"{name} must be positive, got {value!r}")
    return number


def _flag(name, value) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).lower()
    if text not in ("true", "false"):
        raise ValueError(f"{name} must be true or false, got {value!r}")
    return text == "true"


def _transform(name, value) -> str:
    transform_named(str(value))
    return str(value).lower()


def _space(name, value) -> str:
    return str(value)


def _resolve(cls, names, spark, options, given):
    found = {}
    for attribute, (name, parse) in names.items():
        value = given.pop(attribute, None)
        if value is None:
            value = lookup(spark, options, name)
        if value is not None:
            found[attribute] = parse(name, value)
    if given:
        raise TypeError(f"unknown options: {sorted(given)}")
    if "space" not in found:
        raise ValueError("no space was named")
    return cls(**found)


@dataclass(frozen=True)
class ReadOptions:
    space: str
    cursor_batch_size: int = 1000
    batch_size: int = 1000
    conditions: Conditions = Conditions()

    @classmethod
    def resolve(cls, spark=None, options=None, **given) -> ReadOptions:
        conditions = given.pop("conditions", None)
        names = {
            "space": ("space", _space),
            "cursor_batch_size": ("cursorBatchSize", _positive),
            "batch_size": ("batchSize", _positive),
        }
        resolved = _resolve(cls, names, spark, options, given)
        return resolved if conditions is None else resolved.with_conditions(conditions)

    def with_conditions(self, conditions: Conditions) -> ReadOptions:
        return replace(self, conditions=conditions)


@dataclass(frozen=True)
class WriteOptions:
    space: str
    batch_size: int = 1000
    stop_on_error: bool = True
    rollback_on_error: bool = True
    transform_field_names: str = "none"

    @classmethod
    def resolve(cls, spark=None, options=None, **given) -> WriteOptions:
        names = {
            "space": ("space", _space),
            "batch_size": ("batchSize", _positive),
            "stop_on_error": ("stopOnError", _flag),
            "rollback_on_error": ("rollbackOnError", _flag),
            "transform_field_names": ("transformFieldNames", _transform),
        }
        return _resolve(cls, names, spark, options, given)
