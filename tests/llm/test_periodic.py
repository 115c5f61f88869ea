"""Periodic runs against every period tried at every place."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from stowage.llm import periodic
from stowage.llm.queries import op11_periodic_runs

from conftest import SF


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(words, least=6, times=4):
    n, found = len(words), set()
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            start, length = i, j - i + q
            if j > i and length >= max(least, times * q):
                own = words[start : start + length]
                if all(own[: length - p] != own[p:] for p in range(1, q)):
                    found.add((start, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_rest(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def kernel_runs(texts):
    _, columns = periodic._kernel(pa.array(texts, pa.large_string()), 6, 4)
    return [[(r["start"], r["length"], r["period"]) for r in runs] for runs in columns[1].to_pylist()], columns


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=40), min_size=1, max_size=4))
def test_two_words(lists):
    texts = [" ".join(w) for w in lists]
    assert kernel_runs(texts)[0] == [plain_runs(w) for w in lists]


def test_random_texts_with_periodic_ends():
    draw = random.Random(3)
    texts = []
    for _ in range(300):
        words = [draw.choice("abcdé"[: draw.choice([1, 2, 3, 5])]) for _ in range(draw.randint(0, 80))]
        if words and draw.random() < 0.7:
            a = draw.randrange(len(words))
            p = 1 + (len(words) - a) // draw.randint(3, 10)
            words = [words[i if i < a else a + (i - a) % p] for i in range(len(words))]
        texts.append("\t".join(words) + " \n")
    found, columns = kernel_runs(texts)
    for i, text in enumerate(texts):
        words, expected = words_of(text), plain_runs(words_of(text))
        assert found[i] == expected
        assert columns[5][i].as_py() == plain_rest(words, expected)
        longest = min(expected, key=lambda r: (-r[1], r[0], r[2])) if expected else (None,) * 3
        assert tuple(c[i].as_py() for c in columns[2:5]) == longest


def test_one_word_over_and_over_is_near_linear():
    found, columns = kernel_runs(["the " * 300_000 + "end", "a b " * 100_000])
    assert found == [[(0, 300_000, 1)], [(0, 200_000, 2)]]
    assert [c.as_py() for c in columns[5]] == ["the end", "a b"]


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        periodic.find_runs(*[periodic.np.zeros(1, int)] * 2, times=3)


def test_awkward_rows(awkward):
    rows = periodic.periodic_runs(awkward).collect()
    assert len(rows) == awkward.count()
    of = {r.doc_id: r for r in rows}
    for nothing in (1, 2, 3):
        assert (of[nothing].n_words, of[nothing].runs, of[nothing].start, of[nothing].collapsed) == (0, [], None, "")
    assert [tuple(r) for r in of[6].runs] == [(0, 27_000, 9)]
    assert of[6].collapsed == "the quick brown fox jumps over the lazy dog"
    assert of[None].n_words == 9 and of[7].n_words == 1
    assert sum(r.doc_id == 5 for r in rows) == 2


def test_empty_table(empty):
    assert periodic.periodic_runs(empty).count() == 0


def test_query(spark, documents):
    def plain(doc_id, text):
        words = words_of(text)
        h = zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        found = plain_runs(words)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        start, length, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        milli = length and 1000 * length // q
        return doc_id, len(found), start, length, q, milli, digest(lines), digest(plain_rest(words, found))

    short = {r.doc_id: r.text for r in documents.collect() if len(r.text or "") < 12_000}
    rows = {r.doc_id: tuple(r) for r in op11_periodic_runs(spark, SF).collect()}
    assert len(rows) == documents.count()
    planted = [i for i in short if zlib.crc32(str(i).encode()) % 10 == 0]
    assert len(planted) > 10
    for i in planted + list(short)[:60]:
        assert rows[i] == plain(i, short[i])
