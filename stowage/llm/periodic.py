"""Periodic runs of words, found online along sparse diagonals.

A run is a stretch of consecutive words with smallest period q, at least
``max(least, times * q)`` words long, that no neighbouring word extends. Seen as a
dynamic programme over pairs of equal words, a run is a diagonal: lag q, and a match
length that grows by one with each word that equals the word q before it.

Following a lag for every earlier occurrence of every word is quadratic in frequent words,
so a word opens the diagonal of an earlier occurrence only where the stretch before both
agrees as far back as the lag reaches: at level m, the last m words end at the word and
have their latest earlier occurrence q words before it, m / 2 < q <= m. A run holds its
period at least four times, so each run opens its diagonal at the level of its period,
at the same word at which its match length reaches m, and the lag is its smallest period
because the occurrence is the latest. From there each word adds one to the match length
of its active lags, and a lag that is not continued ends; if long enough, its run is
emitted there. At most a logarithm of lags are active at a word, so the work is near
n log n whatever repeats. Words and stretches are compared by exact numbers, not by hashes.

Defined results: a null or empty text has no words, no runs and an empty rest; rows
with equal or null identifiers are texts of their own; an empty table gives no rows;
of the columns only the identifier and the text are read. A very long text is handled
alone, in memory proportional to its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stowage.llm.kernels import blocks, runs
from stowage.llm.tables import ID, TEXT, map_texts

LEAST, TIMES = 6, 4  # words of a run, and periods in it, at least

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _picked(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some stretches one after another, each with ``gap`` bytes before it, and where each starts."""
    ends = np.cumsum(lengths + gap)
    place = np.repeat(starts - (ends - lengths), lengths + gap) + np.arange(int(ends[-1]) if len(ends) else 0)
    return data[np.maximum(place, 0)], ends - lengths


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, the same for equal words."""
    lengths = ends - starts
    compact, at = _picked(data, starts, lengths)
    offsets = np.append(at, len(compact)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(compact)]
    )
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _increments(names: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Level by level (m): words, in order, whose last m words occurred before, and how long before at the latest."""
    document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    longest = int(np.diff(bounds).max(initial=0))
    m, places, keys = 1, np.arange(len(names)), names * len(bounds) + document
    while True:
        # Equal keys side by side, each in the order of the text.
        order = np.argsort(keys, kind="stable")
        ordered, at = keys[order], places[order]
        same = ordered[1:] == ordered[:-1]
        late = np.flatnonzero(same) + 1
        lag = np.zeros(len(names), np.int64)
        lag[at[late]] = at[late] - at[late - 1]
        found = np.flatnonzero((lag > m // 2) & (lag <= m))
        yield m, found, lag[found]
        if m * TIMES > longest:  # the next level's lags exceed m, and a run is TIMES lags long or longer
            return
        # Stretches of 2 m words are named by their halves; a half that occurs once makes no repeat.
        repeated = np.zeros(len(ordered), bool)
        repeated[1:] = same
        repeated[:-1] |= same
        name = np.full(len(names), -1, np.int64)
        name[at[repeated]] = (np.cumsum(np.append(True, ~same)) - 1)[repeated] if len(ordered) else 0
        places = np.flatnonzero(name >= 0)
        places = places[places >= m]
        places = places[name[places - m] >= 0]
        places = places[document[places - m] == document[places]]
        if not len(places):
            return
        keys = name[places] * len(names) + name[places - m]
        m *= 2


def find_runs(
    names: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word in it, length and period of each run, by document, start and period.

    ``names`` are the words of all documents as numbers; those of document i are
    ``bounds[i]`` to ``bounds[i + 1]``. ``times`` is 4 or more.
    """
    if times < TIMES:
        raise ValueError(f"a run holds its period at least {TIMES} times")
    rows = [np.zeros((3, 0), np.int64)]
    for m, words, lags in _increments(names, bounds):
        # A lag is active as long as each word increments it; where it starts, m words match already.
        opens = np.ones(len(words), bool)
        opens[1:] = (np.diff(words) != 1) | (np.diff(lags) != 0)
        first = np.flatnonzero(opens)
        matched = m + np.diff(np.append(first, len(words))) - 1
        lag = lags[first]
        long = matched + lag >= np.maximum(least, times * lag)
        start = words[first] - (m - 1) - lag
        rows.append(np.stack([start, matched + lag, lag])[:, long])
    start, length, period = np.concatenate(rows, axis=1)
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    document = np.searchsorted(bounds, start, "right") - 1
    return document, start - bounds[document], length, period


def _lists(rows: int, owners: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Array:
    offsets = np.searchsorted(owners, np.arange(rows + 1)).astype(np.int32)
    structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], list(columns))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)


def _texts_without(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, keep: np.ndarray
) -> pa.Array:
    """The kept words of each document, joined by one space."""
    chosen = np.flatnonzero(keep)
    lengths = ends[chosen] - starts[chosen]
    joined, at = _picked(data, starts[chosen], lengths, gap=1)
    owner = np.searchsorted(bounds, chosen, "right") - 1
    opening = np.append(True, owner[1:] != owner[:-1])[: len(owner)]
    joined = joined.copy()
    joined[at - 1] = 32
    joined = np.delete(joined, at[opening] - 1)
    sizes = np.bincount(owner, lengths + ~opening, len(bounds) - 1).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(joined))


def _kernel(array: pa.Array, least: int, times: int):
    parts = []
    for first, last, data, offsets in blocks(array):
        starts, ends, bounds = runs(~_SPACE[data], offsets)
        owner, start, length, period = find_runs(word_numbers(data, starts, ends), bounds, least, times)
        # A run's words after its first period go.
        steps = np.zeros(len(starts) + 1, np.int64)
        np.add.at(steps, bounds[owner] + start + period, 1)
        np.add.at(steps, bounds[owner] + start + length, -1)
        rest = _texts_without(data, starts, ends, bounds, np.cumsum(steps)[:-1] == 0)
        rows = last - first
        found = _lists(rows, owner, {"start": start, "length": length, "period": period})
        # The longest run of each document: the first of equally long ones, by start and period.
        best = np.lexsort((period, start, -length, owner))
        best = best[np.append(True, np.diff(owner[best]) != 0)[: len(best)]]
        at = np.full(rows, len(owner))
        at[owner[best]] = best
        longest = pa.array([None if i == len(owner) else i for i in at.tolist()], pa.int64())
        columns = [pa.array(c, pa.int64()).take(longest) for c in (start, length, period)]
        parts.append([pa.array(np.diff(bounds), pa.int64()), found, *columns, rest.cast(pa.string())])
    return None, [pa.concat_arrays(c) for c in zip(*parts)] if parts else _EMPTY


_RUN = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
_EMPTY = [pa.array([], t) for t in (pa.int64(), _RUN, pa.int64(), pa.int64(), pa.int64(), pa.string())]


def periodic_runs(
    docs: DataFrame, id_col: str = ID, text_col: str = TEXT, least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """doc_id, n_words, runs (structs of start, length, period), the longest run's start, length and period,
    and collapsed: the text without what a run repeats, words joined by one space.

    Words are maximal stretches without ASCII white space, numbered from 0. Runs are in
    the order of start and period; of equally long ones the first counts as longest.
    """
    schema = (
        "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
        "start bigint, length bigint, period bigint, collapsed string"
    )
    return map_texts(docs, partial(_kernel, least=least, times=times), schema, id_col, text_col)
