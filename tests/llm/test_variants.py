"""Spelling variants against all pairs of words compared one by one."""

import random
import re
import zlib
from collections import Counter

import pytest

from stowage.llm import variants
from stowage.llm.queries import op12_spelling_variants
from stowage.llm.tables import scratch

from conftest import SF


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain(counts, times_more=2):
    """word -> form, root, n, n_near, form_n."""
    near = {w: [] for w in counts}
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    for w in counts:
        for size in (len(w), len(w) + 1):
            for other in by_length.get(size, ()):
                if (size > len(w) or other > w) and one_edit(w, other):
                    near[w].append(other)
                    near[other].append(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= times_more * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def found(words):
    rows = variants.group_variants(words).collect()
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)


def some_words(draw, letters, n, longest):
    return {"".join(draw.choices(letters, k=draw.randint(5, longest))): draw.randint(3, 40) for _ in range(n)}


@pytest.mark.parametrize("letters, longest", [("ab", 9), ("abcé÷", 6), ("aÿz", 12)])
def test_random_words(spark, letters, longest):
    counts = some_words(random.Random(longest), letters, 500, longest)
    assert found(table(spark, counts)) == plain(counts)


def test_crowded_and_wide_states_are_dealt_again(spark):
    draw = random.Random(8)
    counts = {"prefix" + w: n for w, n in some_words(draw, "abc", 400, 7).items()}
    long = "".join(draw.choices("xyz", k=1000))
    counts |= {long: 50, long[:500] + long[501:]: 20, long + "x": 7, "x" + long: 9, "x" * 700: 3, "x" * 701: 6}
    words = table(spark, counts)
    kept = scratch(spark)
    states = variants.initial_states(words, kept, 5, 5)
    worst = states.groupBy("key").count().where("count > 1").join(states.dropDuplicates(["key"]), "key").collect()
    for r in worst:
        places = r.short - (r.kind == variants.REPLACED) - r.left - r.right + 1
        assert places == 1 or (r["count"] <= 5 and places <= variants.OPEN)
    rows = variants.group_variants(words, crowd=5).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == plain(counts)


def test_states_end_within_a_batch_or_between_two(spark, monkeypatch):
    counts = some_words(random.Random(9), "abc", 300, 7)
    rows = variants.initial_states(table(spark, counts), scratch(spark), 5, 20_000)
    columns = ["key", "kind", "short", "left", "right", "word", "n"]
    rows = rows.select(columns).orderBy("key").toArrow()
    whole = [b.to_pylist() for b in variants._composed(iter(rows.to_batches()))]
    monkeypatch.setattr(variants, "MACHINE", 10)
    parts = [b.to_pylist() for b in variants._composed(iter(rows.to_batches(max_chunksize=3)))]
    assert len(parts) > 5
    order = lambda lists: sorted((r["word"], r["n_near"], r["best_n"], r["best"]) for rows in lists for r in rows)
    assert order(whole) == order(parts)


def test_the_acceptor_is_minimal():
    machine = variants.Acceptor(sorted(["tap", "taps", "top", "tops"]))
    assert len(machine.final) - 1 == 5  # states before t, a or o, p, s, and at the end
    pairs = set(map(frozenset, machine.pairs(machine.initial, variants.REPLACED, "")))
    assert pairs == {frozenset(p) for p in (("tap", "top"), ("taps", "tops"))}


def test_long_chain_of_forms(spark):
    counts = {"a" * (5 + i): 3 * 2**i for i in range(40)}
    rows = found(table(spark, counts))
    assert rows == plain(counts)
    assert {r[1] for r in rows.values()} == {"a" * 44}


def test_ratio(spark):
    with pytest.raises(ValueError):
        variants.group_variants(table(spark, {"words": 3}), times_more=1)


def test_awkward_rows(spark, awkward, empty, monkeypatch):
    counts = {r.word: r.n for r in variants.count_words(awkward).collect()}
    assert counts == {"quick": 3001, "brown": 3001, "jumps": 3001}
    monkeypatch.setattr(variants, "PIECE", 50)
    text = "Große große größe Größe " * 100 + "x" * 300 + " tail'endings"
    docs = spark.createDataFrame([(None, text), (1, text), (1, text)], "id long, body string")
    got = {r.word: r.n for r in variants.count_words(docs, id_col="id", text_col="body").collect()}
    assert got == {"große": 600, "größe": 600, "x" * 300: 3, "endings": 3}
    assert variants.group_variants(variants.count_words(empty)).count() == 0


def test_query(spark, documents):
    counts = Counter()
    for r in documents.collect():
        text = (r.text or "").translate({c: c + 32 for c in range(65, 91)})
        for word in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{r.doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    expected = plain({w: n for w, n in counts.items() if n >= 3 and len(w) >= 5})
    rows = op12_spelling_variants(spark, SF)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r.word: tuple(r)[1:] for r in rows.collect()} == expected
    assert sum(r[0] is not None for r in expected.values()) > 10
