"""Quality scores by a sparse ensemble of rules over text statistics.

Statistics of every text are taken in one pass. Shallow trees, grown on a bounded
sample of labelled rows, give conjunctions of conditions on statistics (one for each
path); a logistic model with an L1 penalty keeps few of them and is refitted without
the penalty. What remains are Spark column expressions: conditions and weights.

Defined results: null and empty texts have statistics of 0 and are scored by the
rules like any other; without labels (or with one kind only) every score is the
share of label 1, or 0.5; several labels of a row all count; labels other than 0 and
1 don't; repeated rows get equal scores; empty tables give no rows; other columns
are not read.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stowage.llm.kernels import Rolling, blocks, runs
from stowage.llm.learn import bounded_sample, lasso_logistic, logistic
from stowage.llm.tables import ID, TEXT, map_texts, scratch

LABEL_ROWS = 20_000  # labelled rows that rules are fitted on, at most
TREES, DEPTH = 24, 3
PENALTY = 0.002

STATISTICS = (
    "log_words", "mean_word", "log_longest_word", "lower_share", "upper_share", "digit_share", "space_share",
    "stop_share", "exclaim_share", "pipe_share", "symbol_share", "other_share", "caps_words", "marked_words",
    "repeated_words", "distinct_words", "top_word", "log_lines", "log_mean_line", "repeated_lines",
)

_OTHER, _LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _STOP, _EXCLAIM, _PIPE, _SYMBOL = range(10)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _SYMBOL
_KIND[97:123], _KIND[65:91], _KIND[48:58] = _LOWER, _UPPER, _DIGIT
_KIND[[32, 9]], _KIND[[10, 13]] = _SPACE, _LINE
_KIND[[ord(c) for c in ".,;:?'\"()-"]], _KIND[ord("!")], _KIND[ord("|")] = _STOP, _EXCLAIM, _PIPE


def _measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    documents = len(offsets) - 1
    sizes = np.diff(offsets)
    kind = _KIND[data]
    owner = np.repeat(np.arange(documents), sizes)
    shares = np.bincount(owner * 10 + kind, minlength=10 * documents).reshape(documents, 10)
    shares = shares / np.maximum(sizes, 1)[:, None]
    starts, ends, bounds = runs((kind != _SPACE) & (kind != _LINE), offsets)
    n = np.diff(bounds)
    most = np.maximum(n, 1)
    word = np.repeat(np.arange(documents), n)
    length = ends - starts
    rolling = Rolling(data)
    codes = rolling.of(starts, ends)
    total = lambda flags: np.bincount(word, flags, documents)
    lower = np.concatenate([[0], np.cumsum(kind == _LOWER, dtype=np.int64)])
    upper = np.concatenate([[0], np.cumsum(kind == _UPPER, dtype=np.int64)])
    caps = (lower[ends] == lower[starts]) & (upper[ends] - upper[starts] > 1)
    marked = np.isin(kind[ends - 1], [_SYMBOL, _PIPE, _EXCLAIM])
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (word[1:] == word[:-1])
    longest, distinct, top = np.zeros(documents), np.zeros(documents), np.zeros(documents)
    line_starts, line_ends, line_bounds = runs(kind != _LINE, offsets)
    lines = rolling.of(line_starts, line_ends)
    repeated = np.zeros(documents)
    for i in range(documents):
        if n[i]:
            longest[i] = length[bounds[i] : bounds[i + 1]].max()
            counts = np.unique(codes[bounds[i] : bounds[i + 1]], return_counts=True)[1]
            distinct[i], top[i] = len(counts), counts.max()
        if (m := line_bounds[i + 1] - line_bounds[i]) > 1:
            repeated[i] = 1 - len(np.unique(lines[line_bounds[i] : line_bounds[i + 1]])) / m
    line_count = np.diff(line_bounds)
    return np.column_stack([
        np.log1p(n), total(length) / most, np.log1p(longest), shares[:, _LOWER], shares[:, _UPPER], shares[:, _DIGIT],
        shares[:, _SPACE], shares[:, _STOP], shares[:, _EXCLAIM], shares[:, _PIPE], shares[:, _SYMBOL],
        shares[:, _OTHER], total(caps) / most, total(marked) / most, total(again) / most, distinct / most, top / most,
        np.log1p(line_count), np.log1p(sizes / np.maximum(line_count, 1)), repeated,
    ])


def _statistics(array: pa.Array):
    parts = [_measure(data, offsets) for _, _, data, offsets in blocks(array)]
    table = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
    return None, [pa.array(column) for column in table.T]


def statistics(docs: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """The statistics of each text, as columns of their names."""
    return map_texts(docs, _statistics, ", ".join(f"{s} double" for s in STATISTICS), id_col, text_col)


class Rule(NamedTuple):
    """Statistics (by index) and the half-open interval (above, at most) that each has to be in."""

    conditions: tuple[tuple[int, float, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        return reduce(np.logical_and, ((x[:, i] > low) & (x[:, i] <= high) for i, low, high in self.conditions))

    def column(self) -> Column:
        found = []
        for i, low, high in self.conditions:
            if low > -np.inf:
                found.append(F.col(STATISTICS[i]) > low)
            if high < np.inf:
                found.append(F.col(STATISTICS[i]) <= high)
        return F.when(reduce(Column.__and__, found), self.weight).otherwise(0.0)


class Rules(NamedTuple):
    intercept: float
    rules: list[Rule]

    def score(self) -> Column:
        """The score as an expression over the columns of ``statistics``."""
        z = reduce(Column.__add__, (r.column() for r in self.rules), F.lit(float(self.intercept)))
        return 1 / (1 + F.exp(-z))


def _paths(tree) -> set[tuple]:
    """The conditions of every path from the root of a fitted tree to a node below it."""
    found = set()
    stack = [(tree._call_java("rootNode"), {})]
    while stack:
        node, bounds = stack.pop()
        if bounds:
            found.add(tuple((i, low, high) for i, (low, high) in sorted(bounds.items())))
        if node.getClass().getSimpleName() == "InternalNode":
            i, at = node.split().featureIndex(), node.split().threshold()
            low, high = bounds.get(i, (-np.inf, np.inf))
            stack.append((node.leftChild(), bounds | {i: (low, min(high, at))}))
            stack.append((node.rightChild(), bounds | {i: (max(low, at), high)}))
    return found


def learn(measured: DataFrame, labels: DataFrame, label_col: str, rows: int = LABEL_ROWS, id_col: str = ID) -> Rules:
    """Rules from the statistics of labelled rows, at most about ``rows`` of them."""
    # only the driver needs these; workers that import this module do without
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    spark = measured.sparkSession
    own = labels.select(F.col(id_col).alias(ID), F.col(label_col).cast("double").alias("label")).where("label in (0, 1)")
    own = bounded_sample(own, rows, own.count(), ID)
    sample = scratch(spark).table(measured.join(own, ID).select("label", *STATISTICS), "labelled")
    table = sample.toArrow()
    y = table["label"].to_numpy()
    x = np.column_stack([table[s].to_numpy() for s in STATISTICS])
    if len(set(y.tolist())) < 2:
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
        return Rules(float(np.log(share / (1 - share))), [])
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample)
    # rows in one order, so that the same sample gives the same forest
    vectors = vectors.repartition(8, *STATISTICS).sortWithinPartitions("label", *STATISTICS)
    forest = RandomForestClassifier(
        labelCol="label", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="0.5", subsamplingRate=0.7, seed=11
    ).fit(vectors)
    rules = [Rule(path) for path in sorted(set().union(*map(_paths, forest.trees)))]
    # One rule of those that hold for the same rows.
    held = {r.holds(x).tobytes(): r for r in reversed(rules)}
    rules = [r for r in held.values() if 0 < (share := r.holds(x).mean()) < 1]
    table = np.column_stack([np.ones(len(y)), *(r.holds(x) for r in rules)]).astype(float)
    kept = [0, *np.flatnonzero(lasso_logistic(table, y, PENALTY)[1:]) + 1]
    weights = logistic(table[:, kept], y, ridge=0.5)
    return Rules(float(weights[0]), [rules[i - 1]._replace(weight=float(w)) for i, w in zip(kept[1:], weights[1:])])


def score(measured: DataFrame, rules: Rules) -> DataFrame:
    """doc_id and score of rows of statistics."""
    return measured.select(ID, rules.score().alias("score"))
