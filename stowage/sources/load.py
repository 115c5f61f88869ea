"""The steps of one load, from landed rows to the rows of the next version."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stowage.operators.batches import REJECTED, STATUSES, WRITTEN, WriteReport, batch_report
from stowage.operators.claims import BATCH, KEY_REASON, REASON, Claims, FreshClaims, KeyClaims, claims, claims_of, held_claims
from stowage.operators.keys import last_rows
from stowage.operators.landing import PROBLEMS, SEQ, Landing, is_bad
from stowage.operators.validate import LINE
from stowage.options import WriteOptions
from stowage.sources.snapshots import DataFile, Snapshots, Version, as_literal, bound_of


class Load:
    """The steps of one load, over its landed rows."""

    def __init__(self, snapshots: Snapshots, old: Version, landing: Landing, write: WriteOptions, strict: bool):
        self.snapshots, self.old, self.landing, self.write, self.strict = snapshots, old, landing, write, strict
        self.spec, self.scratch = landing.spec, landing.scratch
        self.key = list(self.spec.primary_key)
        self.superseded = self.conflicts = self.rounds = 0
        self.refused = self.statuses = self.places = None

        # One pass over the keys: counts and the span of the first key field.
        fits = ~F.col("_bad")
        bound = bound_of(self.key[0], snapshots.first_type)
        first = F.when(fits, F.lit(None) if bound is None else bound)
        per_key = landing.rows.groupBy(*self.key, is_bad().alias("_bad")).agg(F.count("*").alias("_n"))
        facts = per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("_bad"), F.col("_n"))), F.lit(0)).alias("bad"),
            F.coalesce(F.sum(F.when(fits, F.col("_n") - 1)), F.lit(0)).alias("repeated"),
            F.min(first).alias("low"),
            F.max(first).alias("high"),
        ).first()
        self.total, self.bad, self.repeated = facts["rows"], facts["bad"], facts["repeated"]
        self.low, self.high = facts["low"], facts["high"]
        self.good = self.total - self.bad
        self.counts = {**dict.fromkeys(STATUSES, 0), WRITTEN: self.total}
        if self.bad or self.repeated or self.spec.unique_keys or strict:
            landing.write()

    def _near(self) -> tuple[list[DataFile], DataFrame | None]:
        """The old files and rows whose keys the load could hold, by the span of the first key field."""
        files = [f for f in self.old.files if f.within(self.low, self.high)]
        if not files or not self.good:
            return [], None
        rows = self.snapshots.read(self.old, files)
        if self.low is None:
            return files, rows
        ends = [as_literal(v, self.snapshots.first_type) for v in (self.low, self.high)]
        return files, rows.where(F.col(self.key[0]).between(*ends))

    def _statuses(self) -> DataFrame:
        write = self.write
        found = self.landing.statuses(write.batch_size, write.stop_on_error, write.rollback_on_error, self.refused)
        return self.scratch.table(found, "statuses")

    def settle(self) -> None:
        """Find the rows that the key (in a strict insert) or a unique index refuses, and the status of all rows."""
        if self.good and (self.strict or self.spec.unique_keys):
            deciding = self._claims()
            if deciding.any:
                self._refuse(deciding)
        if self.bad == 0 and self.refused is None:
            return
        if self.statuses is None:
            self.statuses = self._statuses()
        counted = self.statuses.groupBy("status").count().collect()
        self.counts = {**dict.fromkeys(STATUSES, 0), **{r["status"]: r["count"] for r in counted}}
        self.good = self.counts[WRITTEN]

    def _claims(self) -> Claims | FreshClaims | KeyClaims:
        good, position = self.landing.rows.where(~is_bad()), self.landing.position
        if not self.spec.unique_keys and not self.write.rollback_on_error:
            rows = good.select(*dict.fromkeys([*self.key, *position]))
            return KeyClaims(rows, self._near()[1], self.key, position, SEQ, self.scratch, self.repeated > 0)
        load = self.scratch.table(claims_of(good, self.spec, *position), "claimed")
        fields = list(dict.fromkeys([*self.key, *[f for u in self.spec.unique_keys for f in u.fields]]))
        space = self.snapshots.read(self.old) if self.spec.unique_keys and self.old.files else self._near()[1]
        held = None if space is None else held_claims(claims_of(space.select(*fields), self.spec), load, self.scratch)
        places = self._places if self.write.rollback_on_error else None
        return claims(load, held, position, SEQ, self.strict, self.scratch, places)

    def _places(self) -> DataFrame:
        if self.places is None:
            self.places = self.landing.places(self.write.batch_size)
        return self.places

    def _refuse(self, deciding: Claims | FreshClaims | KeyClaims) -> None:
        """Find the refused rows; where the load stops, what is skipped holds nothing: repeat until both agree.

        What is skipped in a part follows from batches before it, so that each turn settles the
        stop of one more part at least.
        """
        found = deciding.refused()
        while True:
            empty = found.isEmpty()
            self.refused = None if empty else found
            if not self.write.stop_on_error or (empty and not self.bad):
                break
            self.landing.numbered(self.write.batch_size, keep=True)
            self.statuses = self._statuses()
            again = deciding.refused(self.statuses)
            if again.count() == found.count() and again.exceptAll(found).isEmpty():
                break
            found = again
        self.rounds = deciding.rounds
        if self.refused is not None:
            self.conflicts = self.refused.count()

    def accepted(self) -> DataFrame:
        """Rows that are written."""
        if self.statuses is None:
            return self.landing.rows
        # The smaller side, as a table of its own, so that its true size decides
        # how it is joined.
        if 2 * self.good < self.total:
            written = self.scratch.table(self.statuses.where(F.col("status") == WRITTEN).select(SEQ), "written")
            return self.landing.rows.join(written, SEQ, "left_semi")
        out = self.scratch.table(self.statuses.where(F.col("status") != WRITTEN).select(SEQ), "unwritten")
        return self.landing.rows.join(out, SEQ, "left_anti")

    def one_per_key(self, accepted: DataFrame) -> DataFrame:
        """The last row of each key; keys alone are compared, and wide rows meet just the list of those to keep or leave."""
        if not self.repeated or self.strict:
            return accepted
        rows, position = accepted, self.landing.position
        if self.spec.unique_keys and self.write.rollback_on_error:  # the order in which claims are decided
            rows, position = rows.join(self._places().select(SEQ, BATCH), SEQ), [BATCH, *position]
        last = self.scratch.table(last_rows(rows, self.key, position, SEQ), "last")
        self.superseded = self.good - last.count()
        if not self.superseded:
            return accepted
        if 2 * self.superseded > self.good:
            return accepted.join(last, SEQ, "left_semi")
        out = self.scratch.table(accepted.select(SEQ).join(last, SEQ, "left_anti"), "superseded")
        return accepted.join(out, SEQ, "left_anti")

    def merged(self, accepted: DataFrame) -> tuple[DataFrame, list[DataFile]]:
        """The rows to write, and the old files whose rows are among them.

        A file is rewritten if the load replaces one of its rows. When a space has
        come to consist of more loads than its ``max_loads``, the smaller half of
        them is written anew as well. A strict insert replaces nothing.
        """
        new = accepted.select(*self.spec.names)
        dropped, met = [], None
        files, near = self._near()
        if near is not None and not self.strict:
            keys = near.select(*self.key, F.col("_metadata.file_path").alias("_file"))
            met = self.scratch.table(keys.join(new.select(*self.key), self.key, "left_semi"), "replaced-keys")
            dropped = self.snapshots.holding(met, files)
        loads = self.old.loads()
        if len(loads) >= self.spec.max_loads:
            small = set(sorted(loads, key=lambda n: (loads[n], n))[: -(-len(loads) // 2)])
            dropped = [f for f in self.old.files if f in dropped or f.load in small]
        if not dropped:
            return new, []
        kept = self.snapshots.read(self.old, dropped)
        if met is not None:
            kept = kept.join(met.drop("_file"), self.key, "left_anti")
        return new.unionByName(kept.select(*self.spec.names)), dropped

    def report(self, version: Version, whole: bool) -> WriteReport:
        """``whole``: with the batches even if no row was refused."""
        report = WriteReport(self.write.space, version.number, self.counts, self.superseded, self.conflicts, rounds=self.rounds)
        reasons = []
        if self.bad:
            # as many kinds of lines as the fields of a space allow
            lines = self.landing.rows.where(is_bad()).select(F.explode(F.split(PROBLEMS, LINE)).alias("reason"))
            reasons += [(r["reason"], r["count"]) for r in lines.groupBy("reason").count().orderBy("reason").collect()]
        if self.refused is not None:
            for r in self.refused.groupBy(REASON).count().orderBy(REASON).collect():
                if r[REASON] == KEY_REASON:
                    reasons.append(("its key is in the space or came earlier in the load", r["count"]))
                else:
                    name = self.spec.unique_keys[r[REASON] - 1].name
                    reasons.append((f"another key holds its value of unique index {name!r}", r["count"]))
        report.reasons = reasons
        if report.failed or whole:
            statuses = self._statuses() if self.statuses is None else self.statuses
            report.batches = self.scratch.table(batch_report(statuses), "batches")
        return report
