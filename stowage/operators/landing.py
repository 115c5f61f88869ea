"""First step of a load: evaluate it once, as records with their checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stowage.functions.names import transform_named
from stowage.functions.shards import shard_of
from stowage.operators.batches import number_batches, row_statuses
from stowage.operators.claims import BATCH, BROKEN
from stowage.operators.mapping import column, record_sources, record_values
from stowage.operators.validate import problem_text
from stowage.sources.files import Scratch
from stowage.spec import SpaceSpec

SEQ, PROBLEMS, PART = "_seq", "_problems", "_part"


@dataclass
class Landing:
    """A landed load.

    ``rows`` holds the record fields, ``_seq`` (arrival order) and ``_problems``
    (empty for a good row), plus copies of the ordering columns that are no
    fields or change on the way in.
    """

    rows: DataFrame
    order: list[str]
    part: str | None
    spec: SpaceSpec
    scratch: Scratch
    written: bool = False
    batches: DataFrame | None = None

    def write(self) -> None:
        """Write the rows to scratch: arrival order and all values are fixed from here on."""
        if not self.written:
            self.rows = self.scratch.table(self.rows, "landed")
            self.written = True

    @property
    def position(self) -> list[str]:
        """Columns that order the load totally."""
        return [*self.order, SEQ]

    def statuses(
        self,
        batch_size: int,
        stop_on_error: bool,
        rollback_on_error: bool,
        refused: DataFrame | None = None,
    ) -> DataFrame:
        """Part, batch, shard and status of each row, by ``_seq``. Of the record only the key is read.

        ``refused`` lists rows, by ``_seq``, that a key or a unique index refuses.
        """
        numbered = self.numbered(batch_size)
        held = None
        if refused is not None:
            numbered = numbered.join(refused.select(SEQ, F.lit(True).alias("_refused")), SEQ, "left")
            held = F.col("_refused").isNotNull()
        done = row_statuses(numbered, F.col("_flag"), stop_on_error, rollback_on_error, held)
        return done.select(SEQ, "write_part", "batch", "shard", "status")

    def numbered(self, batch_size: int, keep: bool = False) -> DataFrame:
        """Part, batch, shard, ordering columns and badness (``_flag``) of each row; ``keep`` those for later calls."""
        if self.batches is not None:
            return self.batches
        spec = self.spec
        if spec.bucket_field is None:
            shard = shard_of([F.col(k) for k in spec.primary_key], spec.shards)
        else:
            shard = F.col(spec.bucket_field)
        narrow = self.rows.select(
            SEQ, shard.alias("shard"), is_bad().alias("_flag"), *self.order, *([self.part] if self.part else [])
        )
        numbered = number_batches(narrow, batch_size, SEQ, self.scratch, self.part, self.order)
        if keep:
            numbered = self.batches = self.scratch.table(numbered, "batches")
        return numbered

    def places(self, batch_size: int) -> DataFrame:
        """By ``_seq``: the position of the first row of the batch and shard, and whether one of their rows is bad."""
        group = ["write_part", "batch", "shard"]
        numbered = self.numbered(batch_size, keep=True)
        # a batch has few rows, and rows without a shard are not undone with others
        whole = numbered.where("shard IS NOT NULL").groupBy(*group).agg(
            F.min(F.struct(*self.position)).alias("_first"), F.max("_flag").alias("_any")
        )
        batch = F.coalesce("_first", F.struct(*self.position)).alias(BATCH)
        broken = F.coalesce("_any", F.lit(False)).alias(BROKEN)
        return self.scratch.table(numbered.join(whole, group, "left").select(SEQ, batch, broken), "places")


def is_bad() -> Column:
    return F.col(PROBLEMS) != ""


def ordering_field(spec: SpaceSpec, sources: dict[str, T.StructField | None], name: str) -> str | None:
    """The field that keeps the values of column ``name`` as they are, so that it can order the load."""
    for field, source in sources.items():
        if source is not None and source.name == name and field != spec.bucket_field:
            stored = spec.schema()[field].dataType
            widened = isinstance(source.dataType, T.IntegralType) and isinstance(stored, T.LongType)
            return field if widened or source.dataType == stored else None
    return None


def land(
    df: DataFrame,
    spec: SpaceSpec,
    scratch: Scratch,
    transform: str = "none",
    by: str = "name",
    order_by: Sequence[str] = (),
    write_part: str | None = None,
    stable: bool = False,
) -> Landing:
    """Turn ``df`` into checked records and write them to scratch.

    Those of a ``stable`` input, which gives the same rows at every evaluation,
    are not written yet. ``order_by`` and ``write_part`` name columns of ``df``; those that are not
    fields of the space are used for the load only.
    """
    steering = [*order_by, *([write_part] if write_part else [])]
    if missing := [c for c in steering if c not in df.columns]:
        raise ValueError(f"the load lacks columns {missing}")
    rename = transform_named(transform)
    ignore = [c for c in steering if rename(c) not in spec.names]
    sources = record_sources(df, spec, transform, by, ignore)
    values = record_values(spec, sources)
    problems = problem_text(spec, sources, values)
    key = [values[k] for k in spec.primary_key]
    if spec.bucket_field is not None:
        values[spec.bucket_field] = F.coalesce(values[spec.bucket_field], shard_of(key, spec.shards))
    order = {ordering_field(spec, sources, c) or f"_order{i}": column(c) for i, c in enumerate(order_by)}
    landed = df.select(
        *[values[n].alias(n) for n in spec.names],
        F.monotonically_increasing_id().alias(SEQ),
        problems.alias(PROBLEMS),
        *[c.alias(n) for n, c in order.items() if n not in spec.names],
        *([column(write_part).alias(PART)] if write_part else []),
    )
    landing = Landing(landed, list(order), PART if write_part else None, spec, scratch)
    if not stable:
        landing.write()
    return landing


def plan_batches(
    df: DataFrame,
    spec: SpaceSpec,
    scratch: Scratch,
    batch_size: int = 1000,
    stop_on_error: bool = True,
    rollback_on_error: bool = True,
    write_part: str | None = None,
    order_by: Sequence[str] = (),
    transform: str = "none",
    by: str = "name",
) -> DataFrame:
    """The records of a load with ``write_part``, ``batch``, ``shard`` and ``status``, writing none of them."""
    landing = land(df, spec, scratch, transform, by, order_by, write_part)
    statuses = landing.statuses(batch_size, stop_on_error, rollback_on_error)
    return landing.rows.join(statuses, SEQ).select(*spec.names, "write_part", "batch", "shard", "status")
