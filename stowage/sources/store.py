"""The store: named spaces under one root folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from stowage.errors import SpaceNotEmpty, SpaceWriteError
from stowage.operators.batches import STATUSES, WriteReport
from stowage.operators.conditions import Conditions, apply_conditions, position_values, scan_order
from stowage.operators.convert import Converter, convert, convert_with
from stowage.operators.landing import land
from stowage.operators.mapping import to_rows
from stowage.operators.paging import SMALL, end_of, nth_of, number_pages, up_to, walk_pages
from stowage.options import ReadOptions, WriteOptions
from stowage.sources.files import Folder, Scratch
from stowage.sources.load import Load
from stowage.sources.partitioner import Partitioner, lay_out
from stowage.sources.snapshots import Snapshots, Version, as_bound, as_literal
from stowage.spec import SpaceSpec

_MODES = ("append", "overwrite", "errorifexists", "error", "ignore")


class SpaceStore:
    """Spaces under ``root``, a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._root = Folder(spark, root)
        self._spaces: dict[str, Snapshots] = {}
        self._scratches: list[Scratch] = []

    # Definitions

    def create(self, space: str, spec: SpaceSpec, if_not_exists: bool = False) -> None:
        if space.startswith("."):
            raise ValueError("names of spaces do not start with a dot")
        if not Snapshots.create(self.spark, self._root.folder(space), spec) and not if_not_exists:
            raise ValueError(f"space {space!r} already exists")

    def exists(self, space: str) -> bool:
        return self._root.exists(space, "spec.json")

    def spec(self, space: str) -> SpaceSpec:
        return self._space(space).spec

    def schema(self, space: str) -> T.StructType:
        """Schema of a scan, from the declared format."""
        return self.spec(space).schema()

    def _space(self, space: str) -> Snapshots:
        if space not in self._spaces:
            self._spaces[space] = Snapshots(self.spark, self._root.folder(space))
        return self._spaces[space]

    def _scratch(self) -> Scratch:
        """A scratch folder under the store's root, which all executors reach."""
        self._scratches.append(Scratch(self.spark, self._root.within(".scratch")))
        return self._scratches[-1]

    def release(self) -> None:
        """Delete the scratch tables behind results of this store: those of :meth:`pages` and of reports."""
        while self._scratches:
            self._scratches.pop().remove()

    # Reads

    def scan(
        self,
        space: str | None = None,
        schema: T.StructType | None = None,
        conditions: Conditions | None = None,
        required: Sequence[str] | None = None,
        partitions: int | None = None,
        by: Sequence[str] | None = None,
        ordered: bool = True,
        options: Mapping[str, object] | None = None,
        partitioner: Partitioner | None = None,
    ) -> DataFrame:
        """The rows of a space.

        ``schema`` replaces the declared one, field by field by name, and
        ``required`` picks columns of it. ``partitions`` spreads the result over
        that many ranges of the columns ``by``, then the primary key, so that a
        frequent value of ``by`` may take several. A ``partitioner`` gives the ranges itself, one
        task each.
        """
        read = ReadOptions.resolve(self.spark, options, space=space, conditions=conditions)
        snapshots = self._space(read.space)
        df, _ = self._conditioned(snapshots, read.conditions, ordered)
        if partitioner is not None:
            if partitions is not None:
                raise ValueError("a scan has a number of partitions or a partitioner")
            df = lay_out(df, snapshots.spec, partitioner, partitioner.bounds(self, read.space, read.conditions))
        if schema is not None or required is not None:
            df = to_rows(df, schema or snapshots.spec.schema(), required)
        if partitions is not None:
            key = snapshots.spec.primary_key
            df = df.repartitionByRange(partitions, *dict.fromkeys([*(by or ()), *[k for k in key if k in df.columns]]))
        return df

    def _conditioned(
        self, snapshots: Snapshots, conditions: Conditions, ordered: bool = True, position: bool = False
    ) -> tuple[DataFrame, Row | None]:
        """A scan of the files that can hold what is asked for, and the last ``position`` of a limited one.

        With a limit, its end is found first over the ordering fields alone, so that
        other fields are read for the stretch up to it. The end of many rows is found by
        counting ranges, and a few rows whose end nobody needs are taken as they come.
        """
        version, spec = snapshots.current(), snapshots.spec
        if conditions == Conditions():
            return snapshots.read(version), None
        order = scan_order(spec, conditions.index)
        low, need = None, conditions.limit
        if order[0] == spec.primary_key[0]:
            starts = []
            if conditions.greater_than is not None:
                starts.append(conditions.greater_than[0])
            if conditions.position is not None:
                starts.append(position_values(spec, conditions, order)[0])
            bounds = [as_bound(v, snapshots.first_type) for v in starts if v is not None]
            low = max((b for b in bounds if b is not None), default=None)
        df, files = snapshots.read(version), None
        if order[0] == spec.primary_key[0]:
            files, high = snapshots.stretch(version, low, need if list(order) == list(spec.primary_key) else None)
            if len(files) < len(version.files):
                df = snapshots.read(version, files)
            if high is not None:
                df = df.where(F.col(order[0]) <= as_literal(high, snapshots.first_type))
        if need is None:
            return apply_conditions(df, spec, conditions, ordered), None
        if not position and need <= SMALL:
            return apply_conditions(df, spec, conditions, ordered), None
        if need > SMALL:
            scratch = self._scratch()
            last = nth_of(df, spec, conditions, scratch)
            scratch.remove()
            self._scratches.remove(scratch)
        else:
            last = end_of(df, spec, conditions) if need else None
        return (df.limit(0) if last is None else up_to(df, spec, conditions, last)), last

    def scan_as(
        self,
        space: str,
        converter: Converter,
        schema: T.StructType | str,
        conditions: Conditions | None = None,
        columns: Sequence[str] | None = None,
    ) -> DataFrame:
        """A scan through ``converter``, which maps a pandas batch of Arrow types to rows of ``schema``.

        Only ``columns`` are read, if given.
        """
        return convert(self.scan(space, conditions=conditions, required=columns), converter, schema)

    def scan_with(
        self,
        space: str,
        factory: Callable[[], Converter],
        schema: T.StructType | str,
        conditions: Conditions | None = None,
        columns: Sequence[str] | None = None,
    ) -> DataFrame:
        """As :meth:`scan_as`, with a converter made by ``factory`` in each task."""
        return convert_with(self.scan(space, conditions=conditions, required=columns), factory, schema)

    def page(
        self,
        space: str | None = None,
        index: str | int = 0,
        after: Row | Mapping | Sequence | None = None,
        size: int | None = None,
        options: Mapping[str, object] | None = None,
    ) -> tuple[DataFrame, Row | None]:
        """The page after ``after`` in index order, and the position to pass next; None past the end.

        ``size`` is ``cursorBatchSize`` unless given.
        """
        read = ReadOptions.resolve(self.spark, options, space=space, cursor_batch_size=size)
        conditions = Conditions(index=index).with_limit(read.cursor_batch_size)
        if after is not None:
            conditions = conditions.start_after(after)
        return self._conditioned(self._space(read.space), conditions, position=True)

    def pages(
        self,
        space: str | None = None,
        index: str | int = 0,
        size: int | None = None,
        columns: Sequence[str] | None = None,
        options: Mapping[str, object] | None = None,
    ) -> DataFrame:
        """The whole space with the 0-based ``page`` of each row in index order.

        Of the fields, the ordering ones and ``columns`` are read; all by default.
        The rows lie in scratch until :meth:`release`.
        """
        read = ReadOptions.resolve(self.spark, options, space=space, cursor_batch_size=size)
        spec = self.spec(read.space)
        if columns is not None:
            columns = list(dict.fromkeys([*scan_order(spec, index), *columns]))
        df = self.scan(read.space, required=columns)
        return number_pages(df, spec, index, read.cursor_batch_size, self._scratch())

    def walk(
        self,
        space: str | None = None,
        index: str | int = 0,
        size: int | None = None,
        columns: Sequence[str] | None = None,
        conditions: Conditions | None = None,
        options: Mapping[str, object] | None = None,
    ) -> Iterator[list[Row]]:
        """All rows in index order, as pages of ``size`` rows (``cursorBatchSize`` by default), for the driver to take in turn.

        The space is sorted once, by ranges, and ranges come one at a time, the next one
        while the last is used. ``conditions`` may set where to begin; their limit and index do not count.
        """
        read = ReadOptions.resolve(self.spark, options, space=space, cursor_batch_size=size, conditions=conditions)
        snapshots = self._space(read.space)
        spec, version = snapshots.spec, snapshots.current()
        order = scan_order(spec, index)
        start = replace(read.conditions, index=index, limit=None)
        df = apply_conditions(snapshots.read(version), spec, start, ordered=False)
        if columns is not None:
            df = df.select(*dict.fromkeys([*order, *columns]))
        return walk_pages(df, order, read.cursor_batch_size, sum(f.rows for f in version.files))

    def is_empty(self, space: str) -> bool:
        snapshots = self._space(space)
        version = snapshots.current()
        return not sum(f.rows for f in version.files)

    def non_empty(self, space: str) -> bool:
        return not self.is_empty(space)

    # Writes

    def truncate(self, space: str) -> None:
        """Remove all rows; the definition stays."""
        snapshots = self._space(space)
        base = snapshots.current()
        if base.files:
            snapshots.add(base, None, base.files)

    def vacuum(self, space: str) -> None:
        """Delete the files of earlier versions. Not while a load or an older scan runs."""
        self._space(space).vacuum()

    def write(
        self,
        df: DataFrame,
        space: str | None = None,
        mode: str = "append",
        options: Mapping[str, object] | None = None,
        by: str = "name",
        order_by: Sequence[str] = (),
        write_part: str | None = None,
        on_error: str = "raise",
        stable_input: bool = False,
        **given,
    ) -> WriteReport:
        """Load ``df`` into a space.

        ``append`` replaces rows by primary key and inserts the others;
        ``overwrite`` empties the space first; ``errorifexists`` refuses and
        ``ignore`` leaves a space that has rows. Rows arrive in the order of
        ``df``'s partitions unless ``order_by`` (and ``write_part``) name
        columns; the last row of a key wins. Batch options are those of
        :class:`stowage.options.WriteOptions`.

        Refused rows raise :class:`SpaceWriteError` once the good ones are
        committed, or are only reported with ``on_error="report"``.

        A report has one row per batch; after an exception, that of its report.

        ``stable_input`` promises that ``df`` gives the same rows at every
        evaluation, as a scan of files does. A load without bad rows, repeated
        keys or unique indexes then writes no scratch copy of it.
        """
        write = WriteOptions.resolve(self.spark, options, space=space, **given)
        mode = mode.lower()
        if mode not in _MODES:
            raise ValueError(f"unknown mode {mode!r}; known: {', '.join(_MODES)}")
        base = self._space(write.space).current()
        if mode in ("errorifexists", "error", "ignore") and sum(f.rows for f in base.files):
            if mode == "ignore":
                return WriteReport(write.space, base.number, dict.fromkeys(STATUSES, 0))
            raise SpaceNotEmpty(f"space {write.space!r} already exists and contains data")
        return self._load(df, write, base, mode == "overwrite", False, by, order_by, write_part, on_error, stable_input)

    def replace_many(self, df: DataFrame, space: str | None = None, **settings) -> WriteReport:
        """Insert or replace by primary key."""
        return self.write(df, space, "append", **settings)

    def insert_many(
        self,
        df: DataFrame,
        space: str | None = None,
        options: Mapping[str, object] | None = None,
        by: str = "name",
        order_by: Sequence[str] = (),
        write_part: str | None = None,
        on_error: str = "raise",
        **given,
    ) -> WriteReport:
        """Insert; a key that the space or an earlier row of the load has is refused."""
        write = WriteOptions.resolve(self.spark, options, space=space, **given)
        base = self._space(write.space).current()
        return self._load(df, write, base, False, True, by, order_by, write_part, on_error, False)

    def insert(self, df: DataFrame, space: str, overwrite: bool = False, **settings) -> WriteReport:
        """Insert into a relation: overwrite it, or fill it if it is empty."""
        return self.write(df, space, "overwrite" if overwrite else "errorifexists", **settings)

    def _load(
        self, df, write: WriteOptions, base: Version, replace_all, strict, by, order_by, write_part, on_error, stable
    ) -> WriteReport:
        if on_error not in ("raise", "report"):
            raise ValueError(f"on_error is 'raise' or 'report', not {on_error!r}")
        snapshots = self._space(write.space)
        old = Version(base.number) if replace_all else base
        scratch = self._scratch()
        report = None
        try:
            landing = land(df, snapshots.spec, scratch, write.transform_field_names, by, order_by, write_part, stable)
            load = Load(snapshots, old, landing, write, strict)
            load.settle()
            if load.good:
                rows, dropped = load.merged(load.one_per_key(load.accepted()))
                version = snapshots.add(base, rows, base.files if replace_all else dropped)
            elif replace_all and base.files:
                version = snapshots.add(base, None, base.files)
            else:
                version = base
            report = load.report(version, on_error == "report")
        finally:
            # The batches of a report are read from scratch later on.
            if report is None or report.batches is None:
                scratch.remove()
                self._scratches.remove(scratch)
            else:
                report.scratch = scratch
        if report.failed and on_error == "raise":
            raise SpaceWriteError(report.message, report)
        return report
