import numpy as np
import pytest
from pyspark.sql import functions as F

from stowage.llm import neighbours
from stowage.llm.queries import op9_neighbours

SF = "/root/testdata/sf0.1"


def test_recall_and_exact_scores(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    points = np.array([r.embedding for r in rows], float)
    by_query = {}
    for r in op9_neighbours(spark, SF).collect():
        by_query.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by_query) == {int(i) for i in ids if i % 20 == 0}
    place = {int(i): p for p, i in enumerate(ids)}
    found = 0
    for query, got in by_query.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, 21))
        scores = points @ points[place[query]]
        assert all(abs(s - scores[place[v]]) < 1e-12 for _, v, s in got)
        assert [(-s, v) for _, v, s in got] == sorted((-s, v) for _, v, s in got)
        scores[place[query]] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        found += len(best & {v for _, v, _ in got})
    assert found / (20 * len(by_query)) >= 0.9


def search(spark, rows, k=3, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string, id string")
    found = neighbours.search(df, F.col("id") % 2 == 0, k=k, **options).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (2, [2.0, 1.0]), (3, [0.5, 0.5]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (10, []),
    ]
    got = search(spark, [(i, v, "x", "y") for i, v in rows])
    assert got == [(0, 1, 2, 2.0), (0, 2, 3, 0.5), (2, 1, 0, 2.0), (2, 2, 3, 1.5)]


def test_norms_and_ties(spark):
    """Many equal vectors, and a long vector that is nearest by product alone; crowded leaves are dealt into blocks."""
    rows = [(i, [1.0, 0.0, 0.0], "", "") for i in range(300)] + [(300, [5.0, 4.0, 0.0], "", "")]
    got = {}
    for q, rank, v, s in search(spark, rows, k=4, leaf_rows=8, recall=1.0):
        got.setdefault(q, []).append((rank, v, s))
    assert got[0] == [(1, 300, 5.0), (2, 1, 1.0), (3, 2, 1.0), (4, 3, 1.0)]
    assert got[2] == [(1, 300, 5.0), (2, 0, 1.0), (3, 1, 1.0), (4, 3, 1.0)]


def test_vectors_without_clusters_reach_the_recall():
    """Random directions are the hard case: the reach follows from measured recall."""
    rng = np.random.default_rng(4)
    points = rng.normal(size=(3000, 48))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    long = neighbours._lengthened(points, 1.0000001)
    forest = [neighbours.grow(long, 64, seed) for seed in range(8)]
    reach = neighbours.reach_for(forest, long, 20, 0.95)
    few = neighbours.reach_for(forest, long, 20, 0.5)
    assert few < reach <= 8 * 3000
    places, found = [t.leaves(long) for t in forest], 0
    for i in range(0, 3000, 30):
        query = np.append(points[i], 0).astype(np.float32)
        scores = points @ points[i]
        scores[i] = -2
        best = np.argsort(-scores)[:20]
        seen = neighbours.visits(forest, query, reach)
        found += sum(any(places[t][b] == leaf for t, leaf in seen) for b in best)
    assert found / 2000 >= 0.9


@pytest.mark.parametrize("block", [16, 2048])
def test_blocks_give_the_same(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    rng = np.random.default_rng(0)
    points = rng.normal(size=(200, 5)).astype(np.float32)
    rows = [(i, p.tolist(), "", "") for i, p in enumerate(points)]
    got = search(spark, rows, k=5, recall=1.0, leaf_rows=1000)
    exact = points.astype(float) @ points.astype(float).T
    np.fill_diagonal(exact, -np.inf)
    for q, rank, v, s in got:
        order = np.lexsort((np.arange(200), -exact[q]))
        assert order[rank - 1] == v
    assert len(got) == 100 * 5


def test_empty_table(spark):
    assert search(spark, []) == []


@pytest.mark.parametrize("options", [{}, {"leaf_rows": 8}])
def test_repeated_rows_take_no_places(spark, options):
    """Ids that stand on three rows, two of them alike: each of the other ids is found once, with its best score."""
    rng = np.random.default_rng(6)
    points = rng.normal(size=(15, 4)).astype(np.float32)
    others = (points + rng.normal(scale=0.1, size=points.shape)).astype(np.float32)
    rows = [(i, p.tolist(), "", "") for i in range(15) for p in (points[i], points[i], others[i])]
    got = search(spark, rows, k=14, recall=1.0, **options)
    both = np.stack([points, others]).astype(float)
    scores = np.einsum("aqd,bmd->abqm", both, both).max(axis=(0, 1))
    np.fill_diagonal(scores, -np.inf)
    for query in range(0, 15, 2):
        mine = [(v, s) for q, _, v, s in got if q == query]
        assert [v for v, _ in mine] == np.argsort(-scores[query])[:14].tolist()
        assert np.allclose([s for _, s in mine], np.sort(scores[query])[::-1][:14])


def test_an_id_on_many_rows_sets_no_bound(spark):
    """Twenty rows of one id near the query; those of other ids are found all the same."""
    rng = np.random.default_rng(7)
    rows = [(1, [1.0, float(x)], "", "") for x in rng.normal(scale=0.01, size=400)]
    rows += [(0, [1.0, 0.0], "", "")] + [(i, [0.9 - i / 1000, 0.1], "", "") for i in range(3, 40, 2)]
    got = search(spark, rows, k=5, recall=1.0, leaf_rows=1000)
    assert [v for q, _, v, _ in got if q == 0] == [1, 3, 5, 7, 9]


def test_clusters_are_found_in_a_small_part_of_the_rows():
    """Rows scored per query, and recall, with the reach that the sample asks for and the floor that a probe gives."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(100, 32))
    points = centres[rng.integers(0, 100, 10_000)] + 0.25 * rng.normal(size=(10_000, 32))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    long = neighbours._lengthened(points, 1 + 1e-12)
    forest = [neighbours.grow(long, 64, seed) for seed in range(8)]
    reach = neighbours.reach_for(forest, long, 20, 0.95)
    places = [tree.leaves(long) for tree in forest]
    probe = points[rng.permutation(10_000)[:1250]]
    found = scored = saved = 0
    for at in range(0, 2000, 20):
        query = np.append(points[at], 0).astype(np.float32)
        floor = float(np.sort(probe @ points[at])[-20]) - neighbours._ROUNDING
        seen = np.zeros(10_000, bool)
        everywhere = neighbours.visits(forest, query, 1e9, floor)
        for t, leaf in everywhere:
            seen |= places[t] == leaf
        scores = points @ points[at]
        scores[at] = -np.inf
        best = np.argsort(-scores)[:20]
        assert seen[best].all()  # what the floor leaves out cannot be among the nearest
        saved += len(everywhere) < sum(len(tree.sizes) for tree in forest)
        seen[:] = False
        for t, leaf in neighbours.visits(forest, query, reach, floor):
            seen |= places[t] == leaf
        scored += seen.sum()
        found += seen[best].sum()
    assert found / 2000 >= 0.9
    assert scored / 100 <= 10_000 / 5
    assert saved > 50
