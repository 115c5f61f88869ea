"""Rows that a key or a unique index refuses, decided in the order of the load.

A load is taken row by row: a row is refused if another key holds one of its
unique values at that moment (or, in a strict insert, if its key is held); a row
that is taken in gives up what its key held before. Where a batch with a refused
row is undone, batches are taken whole, one after another in the order of their
first rows, and what a batch does is seen by later ones only if none of its rows
is refused. A row, or such a batch, is a *unit* here.

Only keys that compete take part: those with a value that several keys claim, and in
a strict insert those that are held or repeated. Units are decided set-wise, in
rounds of joins and aggregates by value; nothing is gathered by what is connected.
What may bear on a value are the undecided units of all keys that ever claim it; a unit that
is sure to be refused, or is undone for a bad row, bears on nothing and leaves the rounds at
once. In a round, a unit is decided

* if no undecided unit before it bears on its values: by what is held now;
* if another key holds a value of it and has no undecided unit before it: all that ask
  for a frequent value fall at once, however many;
* if one undecided unit before it bears on its values: both ways, and then by that
  unit's outcome. Such units form chains, along which outcomes are composed by doubling,
  so that a chain of any length takes a logarithm of steps within one round.

The first undecided unit is always decided. Rounds grow with the longest path of units
that wait for two or more others each; in random loads, about with the logarithm of their number.

Why rows are refused is found out once, after the rounds: it is then known who held each
value at any time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial, reduce
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stowage.operators.numbering import last_before, number_rows
from stowage.sources.files import Scratch
from stowage.spec import SpaceSpec

KEY, VALUES, REASON = "_key", "_values", "_reason"
BATCH, BROKEN = "_batch", "_broken"
KEY_REASON = 0  # other reasons are the numbers of unique indexes, from 1

_MANY = -1  # in place of the unit that another waits for, if there are several


def _text(name: str, data_type: T.DataType) -> Column:
    value = F.col(name)
    if isinstance(data_type, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(data_type, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0)  # one zero
    elif isinstance(data_type, (T.ArrayType, T.StructType)):
        value = F.to_json(F.struct(value))
    text = value.cast("string")
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)


def token(schema: T.StructType, fields: Sequence[str], number: int) -> Column:
    """A digest of the values of some fields under an index number; NULL if one of them is NULL."""
    parts = [_text(f, schema[f].dataType) for f in fields]
    return F.unhex(F.md5(F.concat(F.lit(f"{number}|"), *parts).cast("binary")))


def claims_of(df: DataFrame, spec: SpaceSpec, *others: str) -> DataFrame:
    """Key token, unique value tokens (NULL where a value is not set) and other columns of some records."""
    schema = df.schema
    values = [token(schema, index.fields, n) for n, index in enumerate(spec.unique_keys, start=1)]
    none = F.array().cast("array<binary>")
    return df.select(
        token(schema, spec.primary_key, 0).alias(KEY), (F.array(*values) if values else none).alias(VALUES), *others
    )


def _each(claims: DataFrame) -> DataFrame:
    return claims.select(KEY, F.explode(VALUES).alias("token")).where("token IS NOT NULL")


def held_claims(space: DataFrame, load: DataFrame, scratch: Scratch) -> DataFrame:
    """The claims of ``space`` that those of ``load`` may meet, by key or by value; the space is read once."""
    wanted = load.select(F.explode(F.concat(F.array(KEY), VALUES)).alias("token")).where("token IS NOT NULL").distinct()
    tokens = space.select("*", F.explode(F.concat(F.array(KEY), VALUES)).alias("token"))
    # A row may be met by several tokens: its key is unique in the space.
    met = tokens.join(wanted, "token", "left_semi").drop("token").distinct()
    return scratch.table(met, "held")


def competing_keys(load: DataFrame, held: DataFrame | None, strict: bool, scratch: Scratch) -> DataFrame:
    """(``_key``, ``token``): keys whose rows may be refused, with the values that several keys claim."""
    every = _each(load) if held is None else _each(load).union(_each(held))
    contested = every.groupBy("token").agg(F.min(KEY).alias("low"), F.max(KEY).alias("high"))
    contested = contested.where("low <> high").select("token")
    found = every.join(contested, "token", "left_semi").distinct()
    if strict:
        again = load.groupBy(KEY).agg(F.count("*").alias("n")).where("n > 1").select(KEY)
        if held is not None:
            again = again.union(load.select(KEY).join(held.select(KEY), KEY, "left_semi")).distinct()
        found = found.union(again.select(KEY, F.col(KEY).alias("token")))
    return scratch.table(found, "competing")


def _tokens() -> Column:
    """n and token: the key's as number 0, then those of the unique indexes."""
    return F.posexplode(F.concat(F.array(KEY), VALUES)).alias("n", "token")


def _states(asks: DataFrame) -> DataFrame:
    """The last row of each key: its place, and its tokens."""
    rows = asks.groupBy(KEY, "at").agg(F.collect_set("token").alias("tokens"))
    return rows.groupBy(KEY).agg(F.max_by("tokens", "at").alias("tokens"), F.max("at").alias("at"))


def _two_first(units: DataFrame, by: str) -> DataFrame:
    """The first two units of each ``by``; before the shuffle, tasks keep no more than that either."""
    rank = F.dense_rank().over(Window.partitionBy(by).orderBy("unit"))
    return units.withColumn("_rank", rank).where("_rank <= 2").drop("_rank")


def _seen(asks: DataFrame, links: DataFrame, states: DataFrame, strict: bool) -> DataFrame:
    """Asks with ``holder`` (the key that holds the value), ``others`` (whether that refuses the row), ``surely``
    (whether it is sure to last until the unit's turn) and ``waits``: the undecided unit before that bears on it.
    """
    units = asks.select(KEY, "unit").distinct()
    bearing = links.join(_two_first(units, KEY), KEY).select("token", "unit").distinct()
    two = _two_first(bearing, "token").groupBy("token").agg(F.min("unit").alias("one"), F.max("unit").alias("two"))
    first_of = units.groupBy(F.col(KEY).alias("holder")).agg(F.min("unit").alias("holder_first"))
    holders = states.select(F.explode("tokens").alias("token"), F.col(KEY).alias("holder"))
    seen = asks.join(two.join(holders.join(first_of, "holder", "left"), "token", "left"), "token")
    others = _refuses(strict)
    several = (F.col("two") > F.col("one")) & (F.col("two") < F.col("unit"))
    return seen.select(
        "unit",
        "at",
        "seq",
        KEY,
        "n",
        "token",
        "holder",
        others.alias("others"),
        (others & F.coalesce(F.col("unit") < F.col("holder_first"), F.lit(True))).alias("surely"),
        F.when(F.col("one") < F.col("unit"), F.when(several, F.lit(_MANY)).otherwise(F.col("one"))).alias("waits"),
    )


def _refuses(strict: bool) -> Column:
    """Whether ``holder``, the key that holds the value of an ask, refuses it."""
    others = F.when(F.col("n") == KEY_REASON, F.lit(strict) & F.col("holder").isNotNull())
    return others.otherwise(F.coalesce(F.col("holder") != F.col(KEY), F.lit(False)))


def _mixed() -> Column:
    """Whether the rows of a unit have to be looked at in turn: others hold a value, or two of its rows ask for one."""
    return F.max("others") | (F.size(F.collect_set("token")) < F.count("*"))


def _units(seen: DataFrame) -> DataFrame:
    """unit, whether it is ``sure`` to be refused, ``mixed``, ``waits``, and how it is decided: now or both ways, if it is."""
    one = F.min("waits") == F.max("waits")
    units = seen.groupBy("unit").agg(
        F.max("surely").alias("sure"),
        _mixed().alias("mixed"),
        F.when(one, F.min("waits")).when(F.min("waits").isNotNull(), F.lit(_MANY)).alias("waits"),
    )
    now = F.col("sure") | F.col("waits").isNull()
    return units.select("unit", "sure", "mixed", "waits", now.alias("now"), (~now & F.expr("waits <> -1")).alias("both"))


def _judged(units: DataFrame, either: DataFrame) -> DataFrame:
    """unit, waits, and if_taken and if_not: the outcome if the unit it waits for is taken in and if it is not.

    ``either`` has what stands against the units that are not decided by ``units`` alone.
    """
    judged = units.where("now OR both").join(either, "unit", "left")
    return judged.select(
        "unit",
        F.when(F.col("both"), F.col("waits")).alias("waits"),
        *[(~F.col("sure") & ~F.coalesce(f"refused_{way}", F.lit(False))).alias(f"if_{way}") for way in ("taken", "not")],
    )


def _judged_rows(seen: DataFrame, asks: DataFrame, strict: bool, scratch: Scratch) -> DataFrame:
    """The judged units of one row."""
    units = scratch.table(_units(seen), "units")
    # What the unit waited for would hold its values, and would have given up what its key held.
    first = asks.groupBy(F.col("unit").alias("waits")).agg(
        F.first(KEY).alias("first_key"), F.collect_set("token").alias("first_tokens")
    )
    waiting = seen.drop("waits").join(units.where("both").select("unit", "waits"), "unit").join(first, "waits")
    is_key = F.col("n") == KEY_REASON
    taken = F.when(is_key, F.lit(strict)).otherwise(F.col("first_key") != F.col(KEY))
    given = ~is_key & F.coalesce(F.col("holder") == F.col("first_key"), F.lit(False))
    then = F.when(F.array_contains("first_tokens", F.col("token")), taken).otherwise(F.col("others") & ~given)
    either = waiting.groupBy("unit").agg(F.max(then).alias("refused_taken"), F.max("others").alias("refused_not"))
    return _judged(units, either)


def _row_by_row(rows: list[tuple], held: dict[bytes, bytes], strict: bool) -> list[tuple[int, int]]:
    """Take the rows of a batch in turn, given who holds what; the refused ones with their reasons."""
    refused, own = [], {}
    for token, key in held.items():
        own.setdefault(key, set()).add(token)
    for seq, key, tokens in rows:
        reason = None
        for n, token in tokens:
            holder = held.get(token)
            if holder is not None and (strict if n == KEY_REASON else holder != key):
                reason = n
                break
        if reason is not None:
            refused.append((seq, reason))
            continue
        for token in own.pop(key, ()):
            del held[token]
        held.update((token, key) for _, token in tokens)
        own[key] = {token for _, token in tokens}
    return refused


_OF_UNIT = ["unit", "own", "at", "n", "seq", KEY, "token", "holder"]
_PUT_OUT = 4096  # rows of a record batch


def _in_turn(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list, dict]]:
    """Of each unit: the rows of the unit it waits for, its own rows, and who holds what."""
    asks = (ask for batch in batches for ask in zip(*[batch.column(c).to_pylist() for c in _OF_UNIT]))
    for unit, of_unit in groupby(asks, itemgetter(0)):
        before, rows, held = [], [], {}
        for (_, own, _), of_row in groupby(of_unit, itemgetter(0, 1, 2)):
            tokens = []
            for _, _, _, n, seq, key, token, holder in of_row:
                tokens.append((n, token))
                if holder is not None:
                    held[token] = holder
            (rows if own else before).append((seq, key, tokens))
        yield unit, before, rows, held


def _record_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, _PUT_OUT)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _outcomes(batches: Iterator[pa.RecordBatch], strict: bool) -> Iterator[pa.RecordBatch]:
    """Whether a row of each unit is refused, if the unit it waits for is taken in and if it is not."""

    def outcomes():
        for unit, before, rows, held in _in_turn(batches):
            refused = then = bool(_row_by_row(rows, dict(held), strict))
            if before:
                # all its rows were taken in, as it was not undone
                _row_by_row(before, held, strict=False)
                then = bool(_row_by_row(rows, held, strict))
            yield unit, then, refused

    schema = pa.schema([("unit", pa.int64()), ("refused_taken", pa.bool_()), ("refused_not", pa.bool_())])
    return _record_batches(outcomes(), schema)


def _refusals(batches: Iterator[pa.RecordBatch], strict: bool) -> Iterator[pa.RecordBatch]:
    found = (row for _, _, rows, held in _in_turn(batches) for row in _row_by_row(rows, held, strict))
    return _record_batches(found, pa.schema([("seq", pa.int64()), ("reason", pa.int32())]))


def _by_unit(asks: DataFrame) -> DataFrame:
    return asks.select(_OF_UNIT).repartition("unit").sortWithinPartitions("unit", "own", "at", "n")


def _judged_batches(seen: DataFrame, asks: DataFrame, strict: bool, scratch: Scratch) -> DataFrame:
    """The judged units that are batches: the rows of one batch are looked at in turn, in one place, where that matters."""
    units = scratch.table(_units(seen), "units")
    open_ = units.where("both OR now AND mixed AND NOT sure")
    own = seen.drop("waits").join(open_.select("unit"), "unit", "left_semi").withColumn("own", F.lit(True))
    waiting = units.where("both").select(F.col("unit").alias("by"), F.col("waits").alias("unit"))
    before = asks.join(waiting, "unit").drop("unit").withColumnRenamed("by", "unit").withColumn("own", F.lit(False))
    before = before.withColumn("holder", F.lit(None).cast("binary"))
    both = _by_unit(own.select(_OF_UNIT).unionByName(before.select(_OF_UNIT)))
    schema = "unit bigint, refused_taken boolean, refused_not boolean"
    return _judged(units, both.mapInArrow(partial(_outcomes, strict=strict), schema))


def _holders(asked: DataFrame, history: DataFrame, scratch: Scratch) -> DataFrame:
    """token, unit and ``holder``: the key that holds the value when the unit's turn comes, of pairs ``asked``.

    ``history`` are the values (KEY, at, token) of all rows taken in. A row gives up what the one before of its key held.
    """
    rows = history.select(KEY, "at").distinct()
    again = rows.groupBy(KEY).count().where("count > 1").select(KEY)
    rows = rows.join(again, KEY, "left_semi").withColumn("back", -F.col("at"))
    following = last_before(rows, ["back"], "at", scratch, [KEY], "next").where("next IS NOT NULL")
    given = history.join(following.select(KEY, "at", "next"), [KEY, "at"]).select("token", F.col("next").alias("at"))
    nobody, nothing = F.lit(bytearray()), F.lit(None).cast("binary")
    events = given.select("token", "at", F.lit(0).alias("kind"), nobody.alias("by")).unionByName(
        history.select("token", "at", F.lit(1).alias("kind"), F.col(KEY).alias("by"))
    )
    events = events.join(asked.select("token").distinct(), "token", "left_semi").unionByName(
        asked.select("token", F.col("unit").alias("at"), F.lit(2).alias("kind"), nothing.alias("by"))
    )
    found = last_before(events, ["at", "kind"], "by", scratch, ["token"], "holder").where("kind = 2")
    return found.select("token", F.col("at").alias("unit"), F.nullif("holder", nobody).alias("holder"))


class Claims:
    """The competing rows of a load, to be decided once or several times.

    ``competing`` are their keys, with the values that several keys claim. ``places`` gives the
    batch of each row by ``seq`` (``BATCH``: the position of its first row, ``BROKEN``: whether
    it has a bad row) if batches are undone as a whole.
    """

    def __init__(
        self,
        load: DataFrame,
        held: DataFrame | None,
        competing: DataFrame,
        order: Sequence[str],
        seq: str,
        strict: bool,
        scratch: Scratch,
        places: Callable[[], DataFrame] | None = None,
    ):
        self._seq, self._strict, self._scratch, self._batches = seq, strict, scratch, places is not None
        self.rounds = 0
        self.any = not competing.isEmpty()
        if not self.any:
            return
        keys = competing.select(KEY).distinct()
        rows = load.join(keys, KEY, "left_semi")
        if self._batches:
            rows = number_rows(rows.join(places(), seq, "left"), [BATCH, *order], scratch, name="at")
            # a window of one batch
            rows = rows.withColumn("unit", F.min("at").over(Window.partitionBy(BATCH)))
        else:
            rows = number_rows(rows, order, scratch, name="at").withColumns({"unit": F.col("at"), BROKEN: F.lit(False)})
        # a key that comes again bears on its own rows as well
        every = load.select(KEY) if held is None else load.select(KEY).union(held.select(KEY))
        again = every.join(keys, KEY, "left_semi").groupBy(KEY).count().where("count > 1")
        self._links = scratch.table(competing.union(again.select(KEY, F.col(KEY).alias("token"))).distinct(), "links")
        dead = F.coalesce(F.col(BROKEN), F.lit(False)).alias("dead")
        asks = rows.select("unit", "at", F.col(seq).alias("seq"), KEY, dead, _tokens())
        self._asks = scratch.table(asks.join(self._links, [KEY, "token"], "left_semi"), "asks")
        tokens = self._asks.select(KEY, "token", "at").limit(0)
        if held is not None:
            tokens = held.select(KEY, _tokens()).join(self._links, [KEY, "token"], "left_semi")
            tokens = tokens.withColumn("at", F.lit(0).cast("long"))
        self._held = scratch.table(_states(tokens), "states")

    def refused(self, statuses: DataFrame | None = None) -> DataFrame:
        """Refused rows (``seq`` and the reason) when rows of ``statuses`` marked as skipped do not take part."""
        kept, asks, states = self._scratch, self._asks, self._held
        if statuses is not None:
            skipped = statuses.where("status = 'skipped'").select(F.col(self._seq).alias("seq"))
            asks = kept.table(asks.join(skipped, "seq", "left_anti"), "asks")
        judge = _judged_batches if self._batches else _judged_rows
        every, asks = asks, asks.where("NOT dead")
        taken = [asks.select("unit").limit(0)]
        while not asks.isEmpty():
            self.rounds += 1
            seen = kept.table(_seen(asks, self._links, states, self._strict), "seen")
            judged = kept.table(judge(seen, asks, self._strict, kept), "judged")
            decided = kept.table(self._decided(judged), "decided")
            taken.append(decided.where("taken").select("unit"))
            rest = kept.table(asks.join(decided, "unit", "left_anti"), "asks")
            if not rest.isEmpty():
                last = states.unionByName(_states(asks.join(taken[-1], "unit", "left_semi"))).groupBy(KEY)
                states = kept.table(last.agg(F.max_by("tokens", "at").alias("tokens"), F.max("at").alias("at")), "states")
            asks = rest
        found = self._reasons(every, reduce(DataFrame.unionByName, taken))
        return kept.table(found.select(F.col("seq").alias(self._seq), F.col("reason").alias(REASON)), "refused")

    def _reasons(self, asks: DataFrame, taken: DataFrame) -> DataFrame:
        """``seq`` and ``reason`` of the refused rows, given the units that are taken in."""
        kept = self._scratch
        known = self._held.select(KEY, "at", F.explode("tokens").alias("token"))
        took = asks.join(taken, "unit", "left_semi").select(KEY, "at", "token")
        history = kept.table(known.unionByName(took), "history")
        out = asks.join(taken, "unit", "left_anti")
        out = kept.table(out.join(history.groupBy("token").agg(F.min("at").alias("first")), "token", "left"), "out")
        asked = kept.table(out.where(F.col("first") < F.col("unit")).select("token", "unit").distinct(), "asked")
        if asked.isEmpty():
            out = out.withColumn("holder", F.lit(None).cast("binary"))
        else:
            out = out.join(_holders(asked, history, kept), ["token", "unit"], "left")
        out = kept.table(out.withColumn("others", _refuses(self._strict)), "asks")
        if not self._batches:
            return out.where("others").groupBy("seq").agg(F.min("n").alias("reason"))
        mixed = out.groupBy("unit").agg(_mixed().alias("mixed")).where("mixed")
        rows = out.join(mixed, "unit", "left_semi").withColumn("own", F.lit(True))
        return _by_unit(rows).mapInArrow(partial(_refusals, strict=self._strict), "seq bigint, reason int")

    def _decided(self, judged: DataFrame) -> DataFrame:
        """unit and ``taken`` of the units that this round decides."""
        chain, names = judged, {c: f"_{c}" for c in judged.columns}
        while not chain.where("waits IS NOT NULL").isEmpty():
            met = chain.join(chain.withColumnsRenamed(names), F.col("waits") == F.col("_unit"), "left")
            # what waits for a unit that stays open stays open
            met = met.where("waits IS NULL OR _unit IS NOT NULL")

            def after(name: str) -> Column:
                follow = F.when(F.col(f"_{name}"), F.col("if_taken")).otherwise(F.col("if_not"))
                return F.when(F.col("waits").isNull(), F.col(name)).otherwise(follow).alias(name)

            stepped = met.select("unit", F.col("_waits").alias("waits"), after("if_taken"), after("if_not"))
            chain = self._scratch.table(stepped, "chain")
        return chain.select("unit", F.col("if_not").alias("taken"))


class FreshClaims:
    """Rows of keys that come once, in the load or in the space: what is taken stays taken.

    A round takes in the rows that come first for all their values among the undecided, and
    leaves out what asks for a value that is taken. Rows with a single contested value
    are all decided in the first round.
    """

    rounds, any = 0, True

    def __init__(self, load: DataFrame, held: DataFrame | None, links: DataFrame, order: Sequence[str], seq: str, scratch: Scratch):
        self._seq, self._scratch = seq, scratch
        rows = load.join(links.select(KEY).distinct(), KEY, "left_semi")
        at = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)])
        asks = rows.select(F.col(seq).alias("seq"), at.alias("at"), F.posexplode(VALUES).alias("n", "token"))
        contested = links.select("token").distinct()
        self._asks = scratch.table(asks.join(contested, "token", "left_semi"), "asks")
        none = F.lit(None).cast(self._asks.schema["at"].dataType)  # before all rows of the load
        self._held = None if held is None else _each(held).select("token", none.alias("taken_at"))

    def refused(self, statuses: DataFrame | None = None) -> DataFrame:
        kept, every, self.rounds = self._scratch, self._asks, 0
        if statuses is not None:
            skipped = statuses.where("status = 'skipped'").select(F.col(self._seq).alias("seq"))
            every = kept.table(every.join(skipped, "seq", "left_anti"), "asks")
        asks, taken = every, []
        if self._held is not None:
            taken.append(kept.table(self._held.join(every, "token", "left_semi"), "taken"))
            asks = kept.table(self._without(asks, taken[0]), "asks")
        while not asks.isEmpty():
            self.rounds += 1
            first = asks.join(asks.groupBy("token").agg(F.min("at").alias("first")), "token").groupBy("at")
            wins = first.agg(F.bool_and(F.col("first") == F.col("at")).alias("wins")).where("wins").select("at")
            won = asks.join(wins, "at", "left_semi").select("token", F.col("at").alias("taken_at"))
            taken.append(kept.table(won, "taken"))
            asks = kept.table(self._without(asks, taken[-1]), "asks")
        if not taken:
            return kept.table(every.select(F.col("seq").alias(self._seq), F.col("n").alias(REASON)).limit(0), "refused")
        # of the values that others hold when a row's turn comes, the first index is the reason
        held = every.join(reduce(DataFrame.unionByName, taken), "token").where("taken_at IS NULL OR taken_at < at")
        reasons = held.groupBy(F.col("seq").alias(self._seq)).agg((F.min("n") + 1).alias(REASON))
        return kept.table(reasons, "refused")

    @staticmethod
    def _without(asks: DataFrame, taken: DataFrame) -> DataFrame:
        """Asks of rows that ask for none of the values taken; those of the takers go as well."""
        met = asks.join(taken.select("token"), "token", "left_semi").select("at").distinct()
        return asks.join(met, "at", "left_anti")


class KeyClaims:
    """A strict insert into a space without unique indexes, row by row: the first row of a key that is free is taken in.

    ``rows`` and the rows of the space, ``held``, have the columns ``key``, which are set; no more
    of them is read. ``repeated``: whether a key may come twice in the load.
    """

    rounds = 1

    def __init__(
        self,
        rows: DataFrame,
        held: DataFrame | None,
        key: Sequence[str],
        order: Sequence[str],
        seq: str,
        scratch: Scratch,
        repeated: bool = True,
    ):
        self._of, self._scratch, self._seq = (held, list(key), list(order), seq, scratch, repeated), scratch, seq
        self._rows, refused = rows, [rows.select(seq).limit(0)]
        if held is not None:
            refused.append(rows.join(held.select(*key), list(key), "left_semi").select(seq))
        if repeated:
            first = rows.groupBy(*key).agg(F.min(F.struct(*order)).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
            refused.append(rows.join(first, list(key)).where(F.col("_first")[seq] != F.col(seq)).select(seq))
        every = reduce(DataFrame.union, refused[1:] or refused)
        every = every.distinct() if len(refused) > 2 else every
        self._refused = scratch.table(every.withColumn(REASON, F.lit(KEY_REASON)), "refused")
        self.any = not self._refused.isEmpty()

    def refused(self, statuses: DataFrame | None = None) -> DataFrame:
        if statuses is None:
            return self._refused
        # rows that are skipped leave a key to later ones
        skipped = statuses.where("status = 'skipped'").select(self._seq)
        return KeyClaims(self._rows.join(skipped, self._seq, "left_anti"), *self._of)._refused


def claims(
    load: DataFrame,
    held: DataFrame | None,
    order: Sequence[str],
    seq: str,
    strict: bool,
    scratch: Scratch,
    places: Callable[[], DataFrame] | None = None,
) -> Claims | FreshClaims:
    """What decides a load: the quick way where no key that competes comes twice and no batches are undone."""
    links = competing_keys(load, held, strict, scratch)
    if places is None and not links.isEmpty():
        every = load.select(KEY) if held is None else load.select(KEY).union(held.select(KEY))
        twice = every.join(links.select(KEY).distinct(), KEY, "left_semi").groupBy(KEY).count().where("count > 1")
        if twice.isEmpty():
            return FreshClaims(load, held, links, order, seq, scratch)
    return Claims(load, held, links, order, seq, strict, scratch, places)
