"""Spaces as a Spark data source: ``spark.read.format("stowage").option("space", name).load()``.

The reader plans one partition per data file of the space's last version and hands
Arrow batches to Spark. Comparisons of a field with a value, which Spark pushes down,
are taken over whole: they leave out files by the span of the primary key's first
field, then row groups and rows, and no filter stays in the plan. Only the columns
of the schema are read; ``schema(...)`` or the option ``columns`` narrow it.

Spark runs a data source's planning in a process without a session, so settings of the
session are those at the time of :func:`register`.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession, types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from stowage.errors import SpaceNotFound
from stowage.options import lookup
from stowage.spec import SpaceSpec

FORMAT = "stowage"
_SETTINGS = ("root", "space", "columns")
# Values of these types compare alike in Spark and in Arrow.
_ALIKE = (T.LongType, T.StringType, T.BooleanType)


def register(spark: SparkSession, root: str | None = None) -> None:
    """Make the format known to a session; ``root`` is the folder of its store, if the option ``root`` is not given."""
    defaults = {name: value for name in _SETTINGS if (value := lookup(spark, None, name)) is not None}
    if root is not None:
        defaults["root"] = root

    class SessionSource(SpaceSource):
        settings = defaults

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SessionSource)


def _files(path: str):
    """A file system and the path on it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return fs.LocalFileSystem(), path


class SpaceSource(DataSource):
    """The data source; options of a call come before what the session had set."""

    settings: Mapping[str, str] = {}

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _option(self, name: str) -> str | None:
        given = dict(self.options)
        for key in (name, f"stowage.{name}", f"spark.stowage.{name}"):
            # names of options have no case
            if given.get(key) is not None or given.get(key.lower()) is not None:
                return given.get(key, given.get(key.lower()))
        return self.settings.get(name)

    def _folder(self) -> str:
        root, space = self._option("root"), self._option("space")
        if space is None:
            raise ValueError("no space was named")
        if root is None:
            raise ValueError("the store's root folder is missing: give option 'root', or register with it")
        return posixpath.join(root, space)

    def _spec(self) -> SpaceSpec:
        files, folder = _files(self._folder())
        try:
            with files.open_input_stream(posixpath.join(folder, "spec.json")) as stream:
                return SpaceSpec.from_json(stream.read().decode())
        except FileNotFoundError as error:
            raise SpaceNotFound(f"no space at {folder}") from error

    def schema(self) -> T.StructType:
        declared, columns = self._spec().schema(), self._option("columns")
        if columns is None:
            return declared
        return T.StructType([declared[c.strip()] for c in columns.split(",")])

    def reader(self, schema: T.StructType) -> SpaceReader:
        spec = self._spec()
        if unknown := [f.name for f in schema if f.name not in spec.names]:
            raise ValueError(f"the space has no fields {unknown}")
        return SpaceReader(self._folder(), spec, schema)


@dataclass
class FilePartition(InputPartition):
    path: str


class SpaceReader(DataSourceReader):
    """Reads the files of a space that can hold what the pushed filters ask for."""

    def __init__(self, folder: str, spec: SpaceSpec, schema: T.StructType):
        self._folder, self._spec, self._schema = folder, spec, schema
        self._taken: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        types = {f.name: f.dataType for f in self._spec.schema()}
        for one in filters:
            sign = _SIGNS.get(type(one))
            name = one.attribute[0] if sign and len(one.attribute) == 1 else None
            if name is None or not isinstance(types.get(name), _ALIKE) and sign != "set":
                yield one
                continue
            self._taken.append((name, sign, getattr(one, "value", None)))

    def partitions(self) -> list[InputPartition]:
        files, folder = _files(self._folder)
        from pyarrow import fs

        versions = files.get_file_info(fs.FileSelector(posixpath.join(folder, "versions"), allow_not_found=True))
        published = sorted(v.path for v in versions if v.base_name.endswith(".json") and not v.base_name.startswith("."))
        if not published:
            return []
        with files.open_input_stream(published[-1]) as stream:
            listed = json.loads(stream.read())["files"]
        first = self._spec.primary_key[0]
        alike = isinstance(self._spec.schema()[first].dataType, _ALIKE)
        asked = [(sign, value) for name, sign, value in self._taken if name == first and alike]
        return [FilePartition(path) for path, _, low, high in listed if low is None or _may_hold(low, high, asked)]

    def read(self, partition: FilePartition | None) -> Iterator:
        import pyarrow as pa
        from pyarrow import dataset
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition is None:  # what Spark reads where there is no partition
            return
        files, folder = _files(self._folder)
        path = posixpath.join(folder, "data", partition.path)
        times = dataset.ParquetFileFormat(read_options={"coerce_int96_timestamp_unit": "us"})
        rows = dataset.dataset(path, filesystem=files, format=times)
        wanted = to_arrow_schema(self._schema)
        found = rows.to_batches(columns=wanted.names, filter=_expression(self._taken))
        for batch in found:
            if batch.num_rows:
                columns = [column.cast(field.type, safe=False) for column, field in zip(batch.columns, wanted)]
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)


_SIGNS = {
    EqualTo: "=",
    GreaterThan: ">",
    GreaterThanOrEqual: ">=",
    LessThan: "<",
    LessThanOrEqual: "<=",
    In: "in",
    IsNotNull: "set",
}


def _may_hold(low, high, asked: list[tuple[str, object]]) -> bool:
    """Whether a file of keys from ``low`` to ``high`` can hold one that is asked for."""
    return all(
        {
            "=": lambda v: low <= v <= high,
            ">": lambda v: high > v,
            ">=": lambda v: high >= v,
            "<": lambda v: low < v,
            "<=": lambda v: low <= v,
            "in": lambda vs: any(v is not None and low <= v <= high for v in vs),
            "set": lambda _: True,
        }[sign](value)
        for sign, value in asked
    )


def _expression(taken: list[tuple[str, str, object]]):
    """All that was taken over, as one Arrow expression; None if there is nothing."""
    import pyarrow.dataset as ds

    whole = None
    for name, sign, value in taken:
        field = ds.field(name)
        one = {
            "=": lambda: field == value,
            ">": lambda: field > value,
            ">=": lambda: field >= value,
            "<": lambda: field < value,
            "<=": lambda: field <= value,
            "in": lambda: field.isin([v for v in value if v is not None]),
            "set": lambda: field.is_valid(),
        }[sign]()
        whole = one if whole is None else whole & one
    return whole
