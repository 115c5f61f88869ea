"""Spelling variants: words one edit apart, by composing acceptors with a one-edit transducer.

Composing the acceptor of a vocabulary with a transducer that passes all symbols but
one, and with the acceptor again, accepts the pairs of words that are one inserted, deleted
or replaced symbol apart. Up to the edit both words take the same path, so the composed
machine is in a state (q, no edit yet, q); after it, it is in (q, edit made, r) and goes on with
the symbols that both states have. Acceptors are minimised, so that states stand for
what may follow, and what two states have in common is worked out once.

A vocabulary does not fit one machine. It is dealt by where the edit may be: pairs whose
first difference is in the later half of the shorter word share its first half, and others
share the second half. Words with a half in common make one initial state, whose
acceptor knows what lies between; a partition is a machine over many initial states.
A pair has one first difference, so that it is found once. Initial states with more than
``CROWD`` words, or with more than ``OPEN`` places where words may differ, are dealt
again by halving these places, as often as needed: with a single one left, there are no
more words than symbols, and pairs of them.

From a partition come no pairs, but one row for each word in an initial state: how many
words are near it there, and the most frequent of them.

Defined results: null and empty texts have no words; rows with equal or null identifiers are
texts of their own; an empty table gives no rows; other columns are not read. Long texts are
read piece by piece, cut where no word is, and words of any length take part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stowage.llm.kernels import texts
from stowage.llm.tables import ID, TEXT, scratch, small_batches
from stowage.sources.files import Scratch

LEAST, TIMES = 5, 3  # symbols of a word, and occurrences of it, at least
CROWD = 20_000  # words of an initial state before it is dealt again
OPEN = 64  # places at which words of an initial state may differ before it is dealt again
MACHINE = 20_000  # words, about, of the initial states that make one machine
HELD = 200_000  # words that a task counts before it passes the counts on
PIECE = 1 << 20  # code points of a long text that are read together

REPLACED, INSERTED = 0, 1
_BREAK = re.compile(r"[^A-Za-zÀ-ÿ]")

Change = Callable[[object, str], str]


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE:
        found = _BREAK.search(text, at + PIECE)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def _counted(batches: Iterator[pa.RecordBatch], least: int, change: Change | None) -> Iterator[pa.RecordBatch]:
    words, held = re.compile(rf"[a-zÀ-ÿ]{{{least},}}"), {}
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)).to_pylist()):
            for piece in _pieces(text):
                # bytes know only the lower case of A to Z
                for word, n in Counter(words.findall(piece.encode().lower().decode())).items():
                    if change is not None:
                        word = change(doc_id, word)
                    if len(word) >= least:
                        held[word] = held.get(word, 0) + n
        if len(held) > HELD:
            yield _table(held)
            held = {}
    yield _table(held)


def _table(held: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])


def count_words(
    docs: DataFrame,
    least: int = LEAST,
    times: int = TIMES,
    change: Change | None = None,
    id_col: str = ID,
    text_col: str = TEXT,
) -> DataFrame:
    """word and n: runs of letters of at least ``least`` code points that occur at least ``times``, A-Z lower-cased.

    ``change`` maps a document's identifier and a word of it to what is counted instead,
    which is not longer; it must always give the same.
    """
    small_batches(docs.sparkSession)
    kept = docs.select(F.col(id_col).alias(ID), F.col(text_col).cast("string").alias(TEXT))
    counted = kept.mapInArrow(partial(_counted, least=least, change=change), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


class Acceptor:
    """The smallest acceptor of some words; state 0 rejects, others have an end mark and arcs."""

    def __init__(self, words: list[str]):
        """``words`` are sorted and distinct."""
        self.final: list[bool] = [False]
        self.arcs: list[dict[str, int]] = [{}]
        self._known: dict[tuple, int] = {}
        self._common: dict[tuple[int, int], list[str]] = {}
        path, before = [[False, {}]], ""
        for word in words:
            shared = 0
            for one, other in zip(before, word):
                if one != other:
                    break
                shared += 1
            self._close(path, before, shared)
            path += [[False, {}] for _ in range(len(word) - shared)]
            path[-1][0] = True
            before = word
        self._close(path, before, 0)
        self.initial = self._state(*path[0])

    def _close(self, path: list, word: str, depth: int) -> None:
        """Nothing more follows the states of the path below ``depth``: equal ones become one."""
        while len(path) - 1 > depth:
            final, arcs = path.pop()
            path[-1][1][word[len(path) - 1]] = self._state(final, arcs)

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, tuple(arcs.items()))
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.final)
            self.final.append(final)
            self.arcs.append(arcs)
        return state

    def common(self, one: int, other: int) -> list[str]:
        """What both states accept."""
        pair = (one, other) if one < other else (other, one)
        found = self._common.get(pair)
        if found is None:
            todo = [pair]  # a stack, as words may be long
            while todo:
                first, second = todo[-1]
                a, b = self.arcs[first], self.arcs[second]
                if len(b) < len(a):
                    a, b = b, a
                nexts = [(s, (a[s], b[s]) if a[s] < b[s] else (b[s], a[s])) for s in a if s in b]
                open_ones = [n for _, n in nexts if n not in self._common]
                if open_ones:
                    todo += open_ones
                    continue
                ends = [""] if self.final[first] and self.final[second] else []
                self._common[todo.pop()] = ends + [s + rest for s, n in nexts for rest in self._common[n]]
            found = self._common[pair]
        return found

    def pairs(self, start: int, kind: int, follows: str) -> Iterator[tuple[str, str]]:
        """Accepted pairs from an initial state: both words from there on; ``follows`` is the symbol after all of them."""
        todo = [(start, "")]
        while todo:
            state, path = todo.pop()
            arcs = list(self.arcs[state].items())
            todo += [(after, path + symbol) for symbol, after in arcs if self.arcs[after]]
            if kind == REPLACED:
                for n, (symbol, after) in enumerate(arcs):
                    for other, beside in arcs[:n]:
                        for rest in self.common(after, beside):
                            yield path + symbol + rest, path + other + rest
            else:
                for symbol, after in arcs:
                    for rest in self.common(state, after):
                        # where the next symbol is the same, the words first differ later on
                        if (rest or follows)[:1] != symbol:
                            yield path + rest, path + symbol + rest


def _near(rows: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
    """For words of whole initial states (key, kind, short, left, right, word, n): word, near words, the best of them."""
    states: dict[tuple, dict[str, int]] = {}
    for key, kind, short, left, right, word, n in rows:
        state = (key, kind, short, left, right, word[:left], word[len(word) - right :])
        states.setdefault(state, {})[word[left : len(word) - right]] = n
    states = {s: words for s, words in states.items() if len(words) > 1}
    # One machine for all of them: an initial state's number is the first symbol.
    numbered = [chr(0x10000 + n) for n in range(len(states))]
    machine = Acceptor([sign + word for sign, words in zip(numbered, states.values()) for word in sorted(words)])
    for sign, ((_, kind, _, _, _, before, behind), words) in zip(numbered, states.items()):
        near, best = Counter(), {}
        for pair in machine.pairs(machine.arcs[machine.initial][sign], kind, behind[:1]):
            for word, other in (pair, pair[::-1]):
                near[word] += 1
                rank = (-words[other], other)
                if word not in best or rank < best[word]:
                    best[word] = rank
        for word, count in near.items():
            n, other = best[word]
            yield before + word + behind, count, -n, before + other + behind


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches`` hold words sorted by the key of their initial state."""
    held: list[pa.RecordBatch] = []

    def machine(table: pa.Table) -> pa.RecordBatch:
        key = table.column("key").to_numpy()
        same = key[1:] == key[:-1]
        alone = ~(np.append(False, same) | np.append(same, False))[: len(key)]
        rows = table.filter(pa.array(~alone))
        found = list(zip(*_near(list(zip(*[c.to_pylist() for c in rows.columns])))))
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, t) for c, t in zip(found or [()] * 4, types)]
        return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) > MACHINE:
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            # the last initial state may go on in the next batch
            whole = int(np.searchsorted(key, key[-1]))
            if whole:
                yield machine(table.slice(0, whole))
                held = table.slice(whole).to_batches()
    if held:
        yield machine(pa.Table.from_batches(held))


def _keyed(words: DataFrame) -> DataFrame:
    """Words with kind, short, left and right, and the key of the initial state that these make."""
    shared = [F.col("word").substr(F.lit(1), F.col("left")), F.expr("right(word, right)")]
    return words.withColumn("key", F.xxhash64("kind", "short", "left", "right", *shared))


def _last() -> Column:
    """The last place at which words of a kind can first differ."""
    return F.col("short") - F.when(F.col("kind") == REPLACED, 1).otherwise(0)


def _halves(words: DataFrame) -> DataFrame:
    """Deal initial states whose words share ``left`` first and ``right`` last symbols by the half that holds the difference."""
    middle = F.floor((F.col("left") + _last() - F.col("right") + 1) / 2).cast("int")
    later = F.struct(middle.alias("left"), F.col("right"))
    earlier = F.struct(F.col("left"), (_last() - middle + 1).cast("int").alias("right"))
    dealt = words.withColumn("half", F.explode(F.array(later, earlier)))
    return _keyed(dealt.select("word", "n", "kind", "short", "half.left", "half.right"))


def initial_states(words: DataFrame, kept: Scratch, least: int, crowd: int) -> DataFrame:
    """word, n, kind, short, left, right, key: every word in its initial states, none of them crowded or wide."""
    size = F.length("word")
    roles = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), short.cast("int").alias("short"))
            for kind, short in ((REPLACED, size), (INSERTED, size), (INSERTED, size - 1))
        ]
    )
    rows = words.select("word", "n", F.explode(roles).alias("role")).select("word", "n", "role.*")
    # one symbol less than the shortest words have: there is no such partner
    rows = rows.where(F.col("short") >= least).withColumns({"left": F.lit(0), "right": F.lit(0)})
    rows, ready = _halves(rows), []
    while True:
        places = _last() - F.col("left") - F.col("right") + 1
        states = rows.where(places > 1).groupBy("key").agg(F.count("*").alias("words"), F.max(places).alias("places"))
        crowded = states.where((F.col("words") > crowd) | (F.col("words") > 1) & (F.col("places") > OPEN))
        crowded = kept.table(crowded.select("key"), "crowded")
        if crowded.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(crowded, "key", "left_anti"))
        rows = kept.table(_halves(rows.join(crowded, "key", "left_semi")), "dealt")
    return reduce(DataFrame.unionByName, ready)


def group_variants(words: DataFrame, times_more: float = 2, least: int = LEAST, crowd: int = CROWD) -> DataFrame:
    """word, n, n_near, form, form_n, root of distinct words of ``least`` or more symbols with their counts ``n``.

    n_near counts the words one edit away. The form is the one of them with the largest n
    (of equal ones the first in code-point order) if that is at least ``times_more`` times
    the word's, else null; the root is where forms of forms end. ``times_more`` is more than 1.
    """
    if times_more <= 1:
        raise ValueError("forms must occur more often than what they stand for")
    kept = scratch(words.sparkSession)
    words = kept.table(words.select("word", "n"), "words")
    states = initial_states(words, kept, least, crowd)
    states = states.select("key", "kind", "short", "left", "right", "word", "n").repartition("key")
    found = states.sortWithinPartitions("key").mapInArrow(
        _composed, "word string, n_near bigint, best_n bigint, best string"
    )
    none = {"n_near": "bigint", "best_n": "bigint", "best": "string"}
    every = words.select("word", "n", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    rank = F.struct(-F.col("best_n"), F.col("best"))
    of_word = every.unionByName(found, allowMissingColumns=True).groupBy("word").agg(
        F.max("n").alias("n"),
        F.coalesce(F.sum("n_near"), F.lit(0)).alias("n_near"),
        F.min(F.when(F.col("best").isNotNull(), rank)).alias("best"),
    )
    best_n = -F.col("best.col1")
    more = best_n >= F.col("n") * times_more
    of_word = of_word.select(
        "word", "n", "n_near", F.when(more, F.col("best.best")).alias("form"), F.when(more, best_n).alias("form_n")
    )
    of_word = kept.table(of_word, "forms")
    root = roots(of_word.where("form IS NOT NULL").select("word", F.col("form").alias("root")), kept)
    return of_word.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))


def roots(links: DataFrame, kept: Scratch) -> DataFrame:
    """word, root of words with a form: each round doubles the way gone, and a way is no longer than counts can double."""
    links = kept.table(links, "roots")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = links.join(on, "root", "left")
        links = kept.table(stepped.select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        ended = links.where("further IS NOT NULL").isEmpty()
        links = links.select("word", "root")
        if ended:
            return links
