"""Versions of a space.

A version is a small file that lists the data files holding the rows, each with the
span of its keys. Files are cut by ranges of the primary key and never changed once
written. A load writes one new folder and publishes the next version file, so
readers see all of a load or nothing, and files that a load does not change are
carried over by name.

    <space>/spec.json
    <space>/versions/0000000003.json
    <space>/data/0000000003-<id>/*.parquet
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stowage.errors import ConcurrentWrite, SpaceNotFound
from stowage.sources.files import Folder
from stowage.spec import SpaceSpec


@dataclass(frozen=True)
class DataFile:
    """A data file under ``data/`` and the least and greatest first key field in it, if that type has bounds."""

    path: str
    rows: int
    low: object = None
    high: object = None

    @property
    def load(self) -> str:
        return self.path.split("/")[0]

    def within(self, low, high) -> bool:
        """Whether the file may hold keys from ``low`` to ``high`` (None: no end)."""
        if self.low is None:
            return True
        return (high is None or self.low <= high) and (low is None or self.high >= low)


@dataclass(frozen=True)
class Version:
    number: int
    files: tuple[DataFile, ...] = ()
    sizes: tuple[tuple[str, int], ...] = ()  # files that each load wrote

    def loads(self) -> dict[str, int]:
        """Rows of each load that the version still holds."""
        rows: Counter = Counter()
        for f in self.files:
            rows[f.load] += f.rows
        return dict(rows)


def bound_of(name: str, data_type: T.DataType) -> Column | None:
    """A column whose values compare like those of field ``name`` and come to Python unchanged."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(name)  # local times are not unique when clocks go back
    if isinstance(data_type, (T.LongType, T.StringType, T.DoubleType, T.DecimalType)):
        return F.col(name)
    return None


def as_literal(value, data_type: T.DataType) -> Column:
    """The field value that a bound stands for."""
    return F.timestamp_micros(F.lit(value)) if isinstance(data_type, T.TimestampType) else F.lit(value).cast(data_type)


def as_bound(value, data_type: T.DataType):
    """A field value in the form of bounds; None if the type has none."""
    if isinstance(data_type, T.TimestampType):
        if isinstance(value, datetime) and value.tzinfo is not None:
            return (value - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
        return None  # what moment it means is for Spark to say
    if isinstance(data_type, T.DecimalType):
        return Decimal(value)
    if isinstance(data_type, T.StringType):
        return value if isinstance(value, str) else None
    if isinstance(data_type, (T.LongType, T.DoubleType)):
        return value if isinstance(value, (int, float)) else None
    return None


def _stored(value):
    return str(value) if isinstance(value, Decimal) else value


class Snapshots:
    def __init__(self, spark: SparkSession, folder: Folder):
        self.spark = spark
        self._folder = folder
        self._versions = folder.folder("versions")
        if not folder.exists("spec.json"):
            raise SpaceNotFound(f"no space at {folder.path}")
        self.spec = SpaceSpec.from_json(folder.read("spec.json"))
        self._first = self.spec.primary_key[0]
        self.first_type = self.spec.schema()[self._first].dataType
        self._read: tuple[int, Version] | None = None
        self._whole: tuple[int, DataFrame] | None = None

    @staticmethod
    def create(spark: SparkSession, folder: Folder, spec: SpaceSpec) -> bool:
        return folder.publish("spec.json", spec.to_json())

    def _published(self) -> list[str]:
        return [n for n in self._versions.names() if n.endswith(".json") and not n.startswith(".")]

    def current(self) -> Version:
        published = self._published()
        if not published:
            return Version(0)
        number = int(published[-1].split(".")[0])
        if self._read is None or self._read[0] != number:
            raw = json.loads(self._versions.read(published[-1]))
            back = Decimal if isinstance(self.first_type, T.DecimalType) else lambda v: v
            files = [DataFile(p, n, *[None if b is None else back(b) for b in ends]) for p, n, *ends in raw["files"]]
            self._read = number, Version(number, tuple(files), tuple(map(tuple, raw["sizes"])))
        return self._read[1]

    def read(self, version: Version, only: Iterable[DataFile] | None = None) -> DataFrame:
        """Rows of a version, of the files ``only`` if given.

        The relation over all files of the last version is kept: files are listed
        once per version, not per scan.
        """
        schema = self.spec.schema()
        if only is None and self._whole is not None and self._whole[0] == version.number:
            return self._whole[1]
        files = list(version.files if only is None else only)
        if not files:
            return self.spark.createDataFrame([], schema)
        # A load of which every file is wanted is one path.
        wanted = Counter(f.load for f in files)
        whole = {load for load, n in version.sizes if wanted.get(load) == n}
        paths = [*sorted(whole), *[f.path for f in files if f.load not in whole]]
        df = self.spark.read.schema(schema).parquet(*[self._folder.within("data", p) for p in paths])
        if only is None:
            self._whole = version.number, df
        return df

    def stretch(self, version: Version, low, need: int | None) -> tuple[list[DataFile], object]:
        """The files that hold the first ``need`` rows (all if None) with a first key field of ``low`` or more,
        and the end of the keys that are enough, None if only the last key is.

        Rows equal to ``low`` may be passed over, so only files that lie above it count.
        """
        files = [f for f in version.files if f.within(low, None)]
        if need is not None and all(f.low is not None for f in files):
            sure = sorted((f.high, f.rows) for f in files if low is None or f.low > low)
            total = 0
            for high, rows in sure:
                total += rows
                if total >= need:
                    return [f for f in files if f.low <= high], high
        return files, None

    def add(self, base: Version, rows: DataFrame | None, dropped: Iterable[DataFile]) -> Version:
        """Publish the version after ``base``: its files but for those ``dropped``, and new ones for ``rows``."""
        number = base.number + 1
        out = set(dropped)
        files = [f for f in base.files if f not in out]
        sizes = dict(base.sizes)
        if rows is not None:
            name = f"{number:010d}-{uuid.uuid4().hex[:8]}"
            self._write(rows, self._folder.within("data", name))
            new = self._files(name)
            files += new
            sizes[name] = len(new)
        alive = {f.load for f in files}
        version = Version(number, tuple(files), tuple((n, s) for n, s in sizes.items() if n in alive))
        text = json.dumps(
            {
                "version": number,
                "sizes": version.sizes,
                "files": [(f.path, f.rows, _stored(f.low), _stored(f.high)) for f in files],
            }
        )
        if not self._versions.publish(f"{number:010d}.json", text):
            raise ConcurrentWrite(f"version {number} of {self._folder.path} was published by another writer")
        self._read = number, version
        return version

    def _write(self, rows: DataFrame, path: str) -> None:
        # Ranges over the whole key: a frequent value of its first field is split.
        key = self.spec.primary_key
        rows.repartitionByRange(*key).sortWithinPartitions(*key).write.parquet(path)

    def _files(self, name: str) -> list[DataFile]:
        """The files of a load, from one pass over the first key field; as many rows as files reach the driver."""
        df = self.spark.read.schema(self.spec.schema()).parquet(self._folder.within("data", name))
        bound = bound_of(self._first, self.first_type)
        ends = [F.lit(None), F.lit(None)] if bound is None else [F.min(bound), F.max(bound)]
        found = df.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"), *ends).collect()
        return sorted((DataFile(f"{name}/{unquote(f)}", *rest) for f, *rest in found), key=lambda f: f.path)

    def holding(self, met: DataFrame, files: Iterable[DataFile]) -> list[DataFile]:
        """Those of some files that are named in column ``_file`` of ``met``."""
        names = {"/".join(unquote(r[0]).split("/")[-2:]) for r in met.select("_file").distinct().collect()}
        return [f for f in files if f.path in names]

    def vacuum(self) -> None:
        """Delete what the current version does not use. Not while a load or an older scan runs."""
        current = self.current()
        for name in self._published():
            if name != f"{current.number:010d}.json":
                self._versions.remove(name)
        used = {f.path for f in current.files}
        alive = {f.load for f in current.files}
        data = self._folder.folder("data")
        for load in data.names():
            if load not in alive:
                data.remove(load)
                continue
            for name in data.folder(load).names():
                if name.endswith(".parquet") and f"{load}/{name}" not in used:
                    data.folder(load).remove(name)
        self._whole = None
