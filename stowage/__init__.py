"""Keyed spaces on Spark."""

from stowage.errors import ConcurrentWrite, SpaceNotEmpty, SpaceNotFound, SpaceWriteError
from stowage.operators.conditions import Conditions
from stowage.options import ReadOptions, WriteOptions
from stowage.sources.store import SpaceStore
from stowage.spec import Field, Index, SpaceSpec

__all__ = [
    "ConcurrentWrite",
    "Conditions",
    "Field",
    "Index",
    "ReadOptions",
    "SpaceNotEmpty",
    "SpaceNotFound",
    "SpaceSpec",
    "SpaceStore",
    "SpaceWriteError",
    "WriteOptions",
]
