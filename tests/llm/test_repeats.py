import hashlib
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stowage.llm.queries import op8_suffix_repeats
from stowage.llm.repeats import _in_order, _index, _pieces, RunIndex, remove_repeats, suffix_order

SF = "/root/testdata/sf0.001"


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), text in zip(rows, texts):
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if counts[text[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(result):
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return sorted((tuple(r) for r in result.select("doc_id", "n_bytes", "n_removed", "n_spans", digest).collect()), key=str)


def test_query_equals_all_strings(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted((tuple(r) for r in op8_suffix_repeats(spark, SF).collect()), key=str) == brute(rows, 400)


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert found(remove_repeats(awkward)) == brute(rows, 400)


def test_empty_table(empty):
    assert found(remove_repeats(empty)) == []


@pytest.mark.parametrize("crowd", [2048, 4, 1])
def test_edited_copies_periods_and_borders(spark, crowd):
    rng = random.Random(5)
    para = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(n))
    shared = [para(120) for _ in range(5)]
    texts = [None, "", "short"]
    for _ in range(40):
        text = para(rng.randint(10, 150))
        if rng.random() < 0.7:
            whole = rng.choice(shared)
            a = rng.randint(0, len(whole) // 2)
            text += whole[a : rng.randint(a, len(whole))] + para(30)
        texts.append(text)
    texts += ["Der " * 300, "Der " * 101, "Der " * 102 + "x", "der " * 99 + "Der " * 101, texts[7], texts[7]]
    texts += ["a" * 399, "a" * 400, "a" * 401, "b" * 400, "\0" * 401]
    base = para(250)
    for _ in range(25):
        text = list(base)
        for _ in range(3):
            text[rng.randrange(len(text))] = rng.choice("XYZW")
        texts.append("".join(text))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(remove_repeats(docs, crowd=crowd)) == brute(rows, 400)


def test_run_samples_give_all_matches():
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 80))) for _ in range(30)]
    index = RunIndex(strings)
    marked = [np.zeros(len(s), bool) for s in strings]
    for places in index.matches(9)[:2]:
        for place, size in zip(places.tolist(), index.matches(9)[2].tolist()):
            i = int(np.searchsorted(index.ends, place, "right"))
            at = place - int(index.starts[i])
            marked[i][at : at + size] = True
    counts = Counter(s[i : i + 9] for s in strings for i in range(len(s) - 8))
    for s, got in zip(strings, marked):
        want = np.zeros(len(s), bool)
        for i in range(len(s) - 8):
            if counts[s[i : i + 9]] > 1:
                want[i : i + 9] = True
        assert (got == want).all()
    assert len(index.run_codes) < sum(map(len, strings))


def edited_copies(anchors, copies, size):
    """Ranges of some anchors: copies of a text with an edit each."""
    rng, rows = random.Random(2), []
    for anchor in range(anchors):
        text = bytes(rng.choice(b"abcdefgh ijklmnop") for _ in range(size))
        for copy in range(copies):
            at = rng.randrange(size)
            rows.append((b"%d-%d" % (anchor, copy), anchor, 0, text[:at] + b"#" + text[at + 1 :]))
    rng.shuffle(rows)
    kinds = {"text": pa.binary(), "anchor": pa.int64(), "first": pa.int64(), "bytes": pa.binary()}
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], list(kinds))


def test_an_index_costs_few_sorts_of_its_bytes():
    """CPU time of an index over near copies, in stable sorts of as many places (2; 10 when each doubling sorted all)."""
    table = edited_copies(300, 6, 560)
    numbers = np.random.default_rng(3).integers(0, 1 << 62, 300 * 6 * 561)

    def least(work):
        took = []
        for _ in range(3):
            begin = time.process_time()
            work()
            took.append(time.process_time() - begin)
        return min(took)

    assert least(lambda: _index(table, 400)) < 6 * least(lambda: np.argsort(numbers, kind="stable"))


def test_index_of_many_pieces_marks_all_repeats():
    table = edited_copies(80, 5, 560)
    assert len(_pieces(np.sort(table["anchor"].to_numpy()), np.full(400, 560))) > 1
    rows = [(n.decode(), b.decode()) for n, b in zip(table["text"].to_pylist(), table["bytes"].to_pylist())]
    marked = {name: np.zeros(560, bool) for name, _ in rows}
    for mark in _index(table, 400).to_pylist():
        marked[mark["text"].decode()][mark["first"] : mark["last"]] = True
    assert [int(marked[name].sum()) for name, *_ in sorted(rows)] == [r[2] for r in brute(sorted(rows), 400)]


def test_pieces_hold_whole_anchors(monkeypatch):
    monkeypatch.setattr("stowage.llm.repeats.INDEX_BYTES", 10)
    assert _pieces(np.array([1, 1, 1, 2, 3, 3, 4]), np.array([9, 9, 9, 1, 1, 1, 9])) == [(0, 3), (3, 6), (6, 7)]
    assert _pieces(np.array([7]), np.array([50])) == [(0, 1)]


@pytest.mark.parametrize("letters", [b"a", b"\0a", bytes(range(256))])
def test_suffix_order_ends_at_the_separators(letters):
    rng = random.Random(4)
    strings = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 70))) for _ in range(40)]
    codes = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.int64) + 1, 0) for s in strings])
    ends = np.cumsum([len(s) + 1 for s in strings])
    stops = np.repeat(ends - 1, [len(s) + 1 for s in strings])
    want = sorted(range(len(codes)), key=lambda p: (codes[p : stops[p]].tolist(), p))
    assert suffix_order(codes, stops).tolist() == want


@pytest.mark.parametrize("bits", [5, 60])
def test_keys_in_order_when_places_fit_beside_them_or_not(bits):
    keys, places = np.array([5, 900, 5, 0, 900]), np.array([1, 2, 3, 4, 7])
    got = _in_order(keys, places, bits)
    assert [g.tolist() for g in got] == [[0, 5, 5, 900, 900], [4, 1, 3, 2, 7]]
