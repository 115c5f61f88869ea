import random
import re

import pytest

from stowage.llm import jaccard
from stowage.llm.queries import op3_jaccard

SF = "/root/testdata/sf0.001"


def brute(rows, n, similar, of=100):
    """(doc_id, n_shingles, component_id) of each row, by all pairs of different sets."""
    lower = {i: i + 32 for i in range(65, 91)}
    sets = []
    for _, text in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(lower)) if w]
        runs = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)] or ([tuple(words)] if words else [])
        sets.append(frozenset(runs))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and (a == b or of * len(a & b) >= similar * len(a | b)):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(
        ((d, len(s), d if not s else least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str
    )


def found(docs, **options):
    return sorted((tuple(r) for r in jaccard.near_duplicates(docs, **options).collect()), key=str)


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_query_equals_all_pairs(spark, documents):
    got = sorted((tuple(r) for r in op3_jaccard(spark, SF).collect()), key=str)
    assert got == brute(rows_of(documents), 4, 85)


def test_awkward_rows(awkward):
    assert found(awkward) == brute(rows_of(awkward), 5, 80)


def test_empty_table(empty):
    assert found(empty) == []


@pytest.mark.parametrize("block_rows, dense", [(2048, 32), (16, 0), (16, 1000)])
def test_families_around_the_threshold(spark, monkeypatch, block_rows, dense):
    """Many edited copies of few texts, chains between them, and a passage that all texts share."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(jaccard, "DENSE", dense)  # 0: all groups verify themselves; 1000: none does
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(25)]
    rows = []
    for family in range(4):
        base = [word() for _ in range(60)] + passage
        for _ in range(45):
            text = list(base)
            for _ in range(rng.randint(0, 6)):
                text[rng.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
        rows += [(len(rows) + k, " ".join([word() for _ in range(30)] + passage)) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(docs, n=4, similar=85) == brute(rows, 4, 85)
    assert found(docs) == brute(rows, 5, 80)


def test_bound_holds_for_points():
    import numpy as np

    rng = np.random.default_rng(3)
    points = rng.integers(0, 5, (300, jaccard.GROUPS)).astype(np.int32)
    points[150:] = points[:150]
    points[150:, :3] += 1
    sizes = points.sum(axis=1)
    a, b, _ = jaccard._candidates(points, sizes, np.arange(300), np.zeros(300, int), 85, 100)
    got = {(min(p), max(p)) for p in zip(a.tolist(), b.tolist())}
    want = {
        (i, j)
        for i in range(300)
        for j in range(i + 1, 300)
        if np.minimum(points[i], points[j]).sum() * 185 >= 85 * (sizes[i] + sizes[j])
        and min(sizes[i], sizes[j]) * 100 >= 85 * max(sizes[i], sizes[j])
    }
    assert got == want and want
