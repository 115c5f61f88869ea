"""Batches of a load and what becomes of each row when some are refused."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from stowage.operators.numbering import block_of, input_part, input_position, look_up, number_rows
from stowage.sources.files import Scratch

WRITTEN, REJECTED, ROLLED_BACK, SKIPPED = "written", "rejected", "rolled_back", "skipped"
STATUSES = (WRITTEN, REJECTED, ROLLED_BACK, SKIPPED)

_CHUNK = "_chunk"
_CHUNK_BATCHES = 1000


@dataclass
class WriteReport:
    """Outcome of a load.

    ``rows`` counts by status; ``superseded`` is how many written rows a later
    row with the same key replaced within the load, ``unique_conflicts`` how
    many rows a key or a unique index refused (they count as rejected), ``rounds``
    in how many rounds that was found out.
    ``reasons`` has every reason with the number of rows it holds for;
    ``batches`` has one row per batch when a row was refused or a report was
    asked for. It is read from scratch until :meth:`close`.
    """

    space: str
    version: int
    rows: dict[str, int]
    superseded: int = 0
    unique_conflicts: int = 0
    batches: DataFrame | None = None
    reasons: list[tuple[str, int]] = field(default_factory=list)
    scratch: Scratch | None = None
    rounds: int = 0

    @property
    def failed(self) -> bool:
        return self.rows.get(REJECTED, 0) > 0

    @property
    def message(self) -> str:
        counts = ", ".join(f"{self.rows.get(s, 0)} {s}" for s in STATUSES)
        why = "; ".join(f"{reason} ({rows})" for reason, rows in self.reasons)
        return f"the load into {self.space!r} left rows out ({counts}): {why}"

    def close(self) -> None:
        """Delete what ``batches`` is read from."""
        if self.scratch is not None:
            self.scratch.remove()
            self.scratch = self.batches = None


def number_batches(
    df: DataFrame,
    batch_size: int,
    sequence: str,
    scratch: Scratch,
    write_part: str | None = None,
    order_by: Sequence[str] = (),
    part: str = "write_part",
    batch: str = "batch",
) -> DataFrame:
    """Add ``part`` and the 0-based ``batch`` of each row within it.

    ``sequence`` is a stored ``monotonically_increasing_id`` of the input. Without
    ``write_part`` and ``order_by`` batches are cut from each input partition as
    its rows arrive, which needs no shuffle; otherwise from each write part in
    the given order, arrival breaking ties.
    """
    if batch_size < 1:
        raise ValueError("the batch size must be positive")
    seq = F.col(sequence)
    if write_part is None and not order_by:
        return df.select(
            "*",
            input_part(seq).alias(part),
            block_of(input_position(seq), batch_size).alias(batch),
            # few enough batches that no chunk has most of a part's rows
            block_of(block_of(input_position(seq), batch_size), _CHUNK_BATCHES).alias(_CHUNK),
        )
    named = df.withColumn(part, F.lit(0) if write_part is None else F.col(write_part))
    numbered = number_rows(named, [*order_by, sequence], scratch, [part], name="_n", chunk=_CHUNK)
    return numbered.withColumn(batch, block_of(F.col("_n") - F.lit(1), batch_size)).drop("_n")


def row_statuses(
    df: DataFrame,
    bad: Column,
    stop_on_error: bool,
    rollback_on_error: bool,
    refused: Column | None = None,
    part: str = "write_part",
    batch: str = "batch",
    shard: str = "shard",
) -> DataFrame:
    """Add ``status`` to rows that :func:`number_batches` numbered.

    A bad row is rejected, and so is one that is ``refused`` unless its batch is
    skipped: whether a key or a unique index refuses a row is found out only
    when its batch is written. With ``stop_on_error`` the batches after a part's
    first failing one are skipped. With ``rollback_on_error`` the rows that
    share a shard and a batch with a bad row are rolled back. The rest is
    written.

    The two lookups are keyed by (part, range) and (part, batch, shard), so no
    join key has more rows than a range or a batch, however uneven the parts.
    """
    refused = F.lit(False) if refused is None else refused
    rows = df.withColumn("_bad", bad).withColumn("_fails", bad | refused)
    status = F.when(F.col("_bad"), F.lit(REJECTED))
    failed = rows.where("_fails").select(part, batch, shard)
    added = ["_bad", "_fails", _CHUNK]
    if stop_on_error:
        first = failed.groupBy(part).agg(F.min(batch).alias("_first_bad"))
        spread = rows.select(part, _CHUNK).distinct()
        rows = look_up(rows, look_up(spread, first, [part]), [part, _CHUNK], "left")
        status = status.when(F.col(batch) > F.col("_first_bad"), F.lit(SKIPPED))
        added.append("_first_bad")
    status = status.when(F.col("_fails"), F.lit(REJECTED))
    if rollback_on_error:
        hit = failed.where(F.col(shard).isNotNull()).distinct().withColumn("_hit", F.lit(True))
        rows = look_up(rows, hit, [part, batch, shard], "left")
        status = status.when(F.col("_hit"), F.lit(ROLLED_BACK))
        added.append("_hit")
    return rows.withColumn("status", status.otherwise(F.lit(WRITTEN))).drop(*added)


def batch_report(statuses: DataFrame, part: str = "write_part", batch: str = "batch") -> DataFrame:
    """Counts per batch: rows expected, then one count per status."""
    return statuses.groupBy(part, batch).agg(
        F.count("*").alias("expected"),
        *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in STATUSES],
    )
