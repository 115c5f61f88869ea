"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Rows get one more component that makes all of them equally long, so that the
largest inner product is the smallest angle. Each tree splits a bounded sample by
hyperplanes halfway between two of its rows, at the median; every row then falls
into one leaf of each tree. A query searches all trees through one priority queue
ordered by how far it lies on the wrong side of a split, until enough rows are in
reach or no subtree is left that can hold a product as large as the ``k`` largest with rows
of the sample; the rows of those leaves are scored exactly, in double precision.

Leaves and the queries that visit them meet in groups of bounded size: a crowded
leaf (equal vectors can't be split) is dealt into blocks of members and of queries.

Defined results: vectors that are null, zero, of another length than most, or that
hold null or non-finite components take no part, and neither do rows without an
identifier. Ties go to the smaller identifier, also among equal vectors. Rows with
one identifier count once, with the best of their scores. With fewer candidates than
asked for, all are returned. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stowage.llm.tables import bound, scratch, small_batches

SAMPLE_ROWS = 65_536  # rows that the trees are fitted on, at most (and a few more)
TREES = 8
LEAF_ROWS = 256
MIN_LEAF_SAMPLE = 16
RECALL = 0.95  # share of the true neighbours to find, as measured on the sample
PROBE_ROWS = 8192  # rows of the sample, an eighth at most, that tell each query which scores are too low for its result
TRIALS = 200  # rows of the sample that the recall is measured with
BLOCK_ROWS = 2048  # members, and queries, that meet in one group
QUERY_ROWS = 256  # queries of one task that looks for leaves
_ROUNDING = 1e-4  # of products in single precision, with room


class Tree:
    """One tree as arrays: node i has a normal, a threshold and two children; a negative child -k-1 is leaf k."""

    def __init__(self, normals: np.ndarray, thresholds: np.ndarray, children: np.ndarray, sizes: np.ndarray):
        self.normals, self.thresholds, self.children, self.sizes = normals, thresholds, children, sizes

    def leaves(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64) if len(self.normals) else np.full(len(points), -1, np.int64)
        while (at := np.flatnonzero(node >= 0)).size:
            side = np.einsum("nd,nd->n", points[at], self.normals[node[at]]) > self.thresholds[node[at]]
            node[at] = self.children[node[at], side.astype(np.int64)]
        return -node - 1


def grow(points: np.ndarray, leaf_rows: int, seed: int) -> Tree:
    rng = np.random.default_rng(seed)
    normals, thresholds, children, sizes = [], [], [], []
    stack = [(np.arange(len(points)), -1, 0)]
    while stack:
        rows, parent, side = stack.pop()
        link = None
        if len(rows) > leaf_rows:
            for _ in range(3):
                a, b = points[rng.choice(rows, 2, replace=False)]
                normal = a - b
                if not (length := np.linalg.norm(normal)):
                    continue
                normal = normal / length
                along = points[rows] @ normal
                middle = float(np.median(along))
                right = along > middle
                if right.any() and not right.all():
                    link = len(normals)
                    normals.append(normal.astype(np.float32))
                    thresholds.append(middle)
                    children.append([0, 0])
                    stack += [(rows[~right], link, 0), (rows[right], link, 1)]
                    break
        if link is None:
            link = -len(sizes) - 1
            sizes.append(len(rows))
        if parent >= 0:
            children[parent][side] = link
    width = points.shape[1]
    return Tree(
        np.array(normals, np.float32).reshape(-1, width),
        np.array(thresholds, np.float32),
        np.array(children, np.int64).reshape(-1, 2),
        np.array(sizes, np.int64),
    )


def visits(forest: list[Tree], query: np.ndarray, reach: float, floor: float = -math.inf) -> list[tuple[int, int]]:
    """The (tree, leaf) pairs that one shared queue gives until their sampled rows come to ``reach``.

    Query and rows have length 1; subtrees in which no product can come to ``floor`` are left out.
    """
    off = [tree.normals @ query - tree.thresholds for tree in forest]
    beyond = None
    if floor > -1:
        # the largest product of the query with a row on the border of a split, and so with any behind it
        beyond = []
        for tree, distance in zip(forest, off):
            along, border = np.clip(distance + tree.thresholds, -1, 1), np.clip(tree.thresholds, -1, 1)
            beyond.append(along * border + np.sqrt((1 - along * along) * (1 - border * border)))
    queue = [(-math.inf, t, 0 if len(tree.normals) else -1) for t, tree in enumerate(forest)]
    heapq.heapify(queue)
    found, rows = [], 0
    while queue and rows < reach:
        wrong, t, node = heapq.heappop(queue)
        while node >= 0:
            distance = float(off[t][node])
            side = int(distance > 0)
            if beyond is None or beyond[t][node] >= floor:
                heapq.heappush(queue, (max(wrong, abs(distance)), t, int(forest[t].children[node, 1 - side])))
            node = int(forest[t].children[node, side])
        leaf = -node - 1
        found.append((t, leaf))
        rows += int(forest[t].sizes[leaf])
    return found


def _by_id(ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each of some sorted identifiers once, with the best of its scores (along the last axis)."""
    first = np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1))
    if len(first) == len(ids):
        return ids, scores
    return ids[first], np.maximum.reduceat(scores, first, axis=-1)


def reach_for(forest: list[Tree], points: np.ndarray, k: int, recall: float, ids: np.ndarray | None = None) -> int:
    """How many rows of the sample a query has to reach so that it finds this share of its ``k`` nearest in the sample.

    Of the rows with one of the ``ids`` the nearest counts.
    """
    ids = np.arange(len(points)) if ids is None else ids
    k = min(k, max(1, len(np.unique(ids)) - 1))
    trials = np.random.default_rng(1).permutation(len(points))[:TRIALS]
    asked = points[trials].copy()
    asked[:, -1] = 0  # a query has no such component
    places = [tree.leaves(points) for tree in forest]
    scores = asked @ points.T
    scores[ids[trials][:, None] == ids] = -np.inf
    order = np.argsort(-scores, axis=1, kind="stable")
    if len(np.unique(ids)) < len(ids):
        order = [row[np.sort(np.unique(ids[row], return_index=True)[1])[:k]] for row in order]
    nearest = np.array([row[:k] for row in order])
    reach = max(64, 4 * k)
    while reach < len(forest) * len(points):
        found = 0
        for query, wanted in zip(asked, nearest):
            length = np.linalg.norm(query)
            seen = {}
            for t, leaf in visits(forest, query / length if length else query, reach):
                seen.setdefault(t, []).append(leaf)
            hit = np.zeros(len(wanted), bool)
            for t, leaves in seen.items():
                hit |= np.isin(places[t][wanted], leaves)
            found += hit.sum()
        if found >= recall * nearest.size:
            return reach
        reach = reach * 5 // 4
    return reach


def _matrix(column) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(array):
        return np.zeros((0, 0))
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1)


def _lengthened(points: np.ndarray, longest: float) -> np.ndarray:
    points = points.astype(np.float64) / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("nd,nd->n", points, points)))
    return np.column_stack([points, rest]).astype(np.float32)


def _assign(batches: Iterator[pa.RecordBatch], forest, longest: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        points = _lengthened(_matrix(batch.column(1)), longest)
        for t, tree in enumerate(forest.value):
            place = [pa.array(np.full(len(points), t, np.int32)), pa.array(tree.leaves(points))]
            yield pa.RecordBatch.from_arrays([*place, batch.column(0), batch.column(1)], ["tree", "leaf", "id", "vec"])


def _visit(batches: Iterator[pa.RecordBatch], forest, probe, reach: float, k: int, longest: float) -> Iterator[pa.RecordBatch]:
    ids, given = probe.value
    for batch in batches:
        if not batch.num_rows:
            continue
        points = _matrix(batch.column(1)).astype(np.float64)
        least = np.full(len(points), -np.inf)
        for i, (own, point) in enumerate(zip(batch.column(0).to_pylist(), points)):
            others, scores = _by_id(ids, given @ point)
            scores = scores[others != own]
            if len(scores) >= k:  # k identifiers are at least as near, so that lower scores can't be among the k best
                least[i] = np.partition(scores, len(scores) - k)[len(scores) - k] - 1e-9
        lengths = np.linalg.norm(points, axis=1, keepdims=True)
        points = np.column_stack([points / lengths, np.zeros(len(points))]).astype(np.float32)
        floors = least / (lengths[:, 0] * longest) - _ROUNDING
        rows, trees, leaves = [], [], []
        for i, point in enumerate(points):
            for t, leaf in visits(forest.value, point, reach, float(floors[i])):
                rows.append(i)
                trees.append(t)
                leaves.append(leaf)
        taken = batch.take(pa.array(rows, pa.int64()))
        place = [pa.array(trees, pa.int32()), pa.array(leaves, pa.int64())]
        bound_ = pa.array(least[rows])
        yield pa.RecordBatch.from_arrays([*place, taken.column(0), taken.column(1), bound_], ["tree", "leaf", "id", "vec", "least"])


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _probed(batches: Iterator[pa.RecordBatch], probe, k: int) -> Iterator[pa.RecordBatch]:
    """The best rows of the probe for each query: they are found, and give a score that the result can't fall below."""
    ids, given = probe.value
    for batch in batches:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for own, point in zip(batch.column(0).to_pylist(), _matrix(batch.column(1)).astype(np.float64)):
            others, scores = _by_id(ids, np.einsum("md,d->m", given, point))
            scores = np.where(others == own, -np.inf, scores)
            best = np.lexsort((others, -scores))[:k]
            best = best[scores[best] > -np.inf]
            out.append((np.full(len(best), own), others[best], scores[best]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=_FOUND)


def _best(queries: pa.Table, members: pa.Table, k: int) -> pa.Table:
    """The ``k`` best members of the group for each query of the group."""
    if not queries.num_rows or not members.num_rows:
        return _FOUND.empty_table()
    asked, ids = queries["id"].to_numpy(), members["id"].to_numpy()
    wanted, given = _matrix(queries["vec"]).astype(np.float64), _matrix(members["vec"]).astype(np.float64)
    order = np.argsort(ids, kind="stable")  # ties keep the smaller identifier
    ids, given = ids[order], given[order]
    least = queries["least"].to_numpy()
    out = []
    for at in range(0, len(asked), 128):
        # einsum sums each product in one order, so that equal vectors get equal scores
        scores = np.einsum("qd,md->qm", wanted[at : at + 128], given)
        others, scores = _by_id(ids, scores)
        for query, row, low in zip(asked[at : at + 128], scores, least[at : at + 128]):
            row = np.where((others == query) | (row < low), -np.inf, row)
            if len(row) > 4 * k:  # all that tie with the k-th stay
                near = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
            else:
                near = np.arange(len(row))
            near = near[np.argsort(-row[near], kind="stable")][:k]
            near = near[row[near] > -np.inf]
            out.append((np.full(len(near), query), others[near], row[near]))
    columns = [np.concatenate(c) for c in zip(*out)]
    return pa.Table.from_arrays([pa.array(c) for c in columns], schema=_FOUND)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Identifier and vector of the rows that take part."""
    vec = F.col("vec")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    kept = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where(
        F.col("id").isNotNull() & F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))
    )
    lengths = kept.groupBy(F.size(vec).alias("n")).count().orderBy(F.desc("count"), "n").head()
    return kept.where(F.size(vec) == (lengths["n"] if lengths else 0))


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    trees: int = TREES,
    leaf_rows: int = LEAF_ROWS,
    recall: float = RECALL,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best rows found for each row where ``is_query`` holds.

    Queries go as far as the share ``recall`` of true neighbours takes, measured by
    brute force within the sample. A query's neighbours among all rows are nearer
    than those in a sample, and are found no less often.

    ``is_query`` is a condition on a column named ``id``.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    kept = scratch(spark)
    rows = kept.table(usable(vectors, id_col, vec_col), "vectors")
    repeated = kept.table(rows.groupBy("id").count().where("count > 1").select("id"), "repeated")
    if not repeated.isEmpty():
        once = rows.join(repeated, "id", "left_semi").distinct()
        rows = kept.table(rows.join(repeated, "id", "left_anti").unionByName(once), "distinct")
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    facts = rows.agg(F.count("*").alias("rows"), F.max(square).alias("square")).head()
    share = min(1.0, sample_rows / max(1, facts["rows"]))
    longest = math.sqrt(facts["square"] or 1.0) * (1 + 1e-12)

    chance = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30))
    taken = rows.where(chance < int(share * (1 << 30)) + 1).select("id", "vec").toArrow()
    sample = taken["vec"]
    points = _lengthened(_matrix(sample), longest) if len(sample) else np.zeros((0, 1), np.float32)
    least = max(MIN_LEAF_SAMPLE if share < 1 else 2, round(leaf_rows * share))
    grown = [grow(points, least, seed) for seed in range(trees)]
    sample_ids = taken["id"].to_numpy()
    reach = reach_for(grown, points, k, recall, sample_ids) if len(points) > 1 else 1
    forest = spark.sparkContext.broadcast(grown)
    some = np.random.default_rng(2).permutation(len(sample))[: min(PROBE_ROWS, len(sample) // 8)]
    some = some[np.argsort(sample_ids[some], kind="stable")]
    near_by = _matrix(sample).astype(np.float64)[some] if len(sample) else np.zeros((0, 1))
    probe = spark.sparkContext.broadcast((sample_ids[some], near_by))

    kind = rows.schema["vec"].dataType.simpleString()
    schema = f"tree int, leaf bigint, id bigint, vec {kind}"
    members = kept.table(rows.mapInArrow(partial(_assign, forest=forest, longest=longest), schema), "members")
    asked = rows.where(is_query)
    tasks = -(-asked.count() // QUERY_ROWS) or 1
    kernel = partial(_visit, forest=forest, probe=probe, reach=reach, k=k, longest=longest)
    asking = kept.table(asked.repartition(tasks).mapInArrow(kernel, f"{schema}, least double"), "queries")

    # Blocks of a leaf: members by queries, each dealt by a hash of its identifier.
    place = ["tree", "leaf"]
    blocks = (
        members.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("m"))
        .join(asking.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("q")), place)
    )

    def dealt(df: DataFrame, own: str, other: str, *more: str) -> DataFrame:
        block = F.pmod(F.xxhash64("id", F.lit("block")), F.col(own)).alias(f"{own}_block")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"{other}_block")
        return df.join(blocks, place).select(*place, "id", "vec", *more, block, every)

    key = [*place, "m_block", "q_block"]
    found = (
        dealt(asking, "q", "m", "least").groupBy(*key).cogroup(dealt(members, "m", "q").groupBy(*key))
        .applyInArrow(bound(_best, k=k), "query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    probed = rows.where(is_query).mapInArrow(partial(_probed, probe=probe, k=k), "query_id bigint, vec_id bigint, score double")
    distinct = found.unionByName(probed).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = distinct.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
