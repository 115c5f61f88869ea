import random
import re

import numpy as np
import pyarrow as pa

from stowage.llm import decontam
from stowage.llm.queries import op10_decontamination

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def least_edits(item, text):
    """Least word edits between the item and any stretch of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def brute(docs, items, share=0.2):
    return {
        (d, i): e
        for d, t in docs
        for i, x in items
        if words(x) and (e := least_edits(words(x), words(t))) <= int(share * len(words(x)) + 1e-9)
    }


def test_query_equals_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text) < 4000]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.edits for r in op10_decontamination(spark, SF).collect()}
    want = brute(docs, items)
    assert want and {k: v for k, v in got.items() if k[0] in dict(docs)} == want


def edited(rng, part, count):
    part = list(part)
    for _ in range(count):
        at = rng.randrange(len(part))
        part[at : at + 1] = rng.choice([["edit%d" % rng.randrange(99)], ["more%d" % rng.randrange(99), part[at]], []])
    return part


def test_edited_passages_are_found(spark):
    """Passages with up to a fifth of their words edited, within other words; and texts without any."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    items = [(i, [word() for _ in range(rng.randint(4, 60))]) for i in range(40)]
    docs, planted = [], set()
    for d in range(240):
        text = [word() for _ in range(rng.randint(0, 80))]
        if d % 2:
            i, part = rng.choice(items)
            text[len(text) // 2 : len(text) // 2] = edited(rng, part, rng.randint(0, len(part) // 5))
            planted.add((d, i))
        docs.append((d, " ".join(text)))
    items = [(i, " ".join(w)) for i, w in items]
    found = decontam.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    got = {(r.doc_id, r.item_id): r.edits for r in found.collect()}
    want = brute(docs, items)
    assert planted <= set(want)
    assert set(got) <= set(want) and all(e >= want[k] for k, e in got.items())
    assert len(got) >= 0.97 * len(want)


def test_awkward_rows(spark, awkward, empty):
    items = [(1, "quick brown FOX jumps, over the lazy dog"), (1, "one"), (2, None), (3, ""), (4, " .,;"), (None, "x"), (5, "中文")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.item_words) for r in decontam.find_leaks(awkward, benchmark).collect()}
    assert got == {(4, 1, 1), (5, 1, 1), (None, 1, 8), (6, 1, 8), (8, 5, 1)}
    counted = {r.doc_id: r.n_items for r in decontam.count_leaks(awkward, benchmark).collect()}
    assert counted == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, None: 1, 6: 1, 7: 0, 8: 1}
    small = decontam.find_leaks(awkward, benchmark, item_bytes=16)
    assert {(r.doc_id, r.item_id, r.item_words) for r in small.collect()} == got
    counted_small = {r.doc_id: r.n_items for r in decontam.count_leaks(awkward, benchmark, item_bytes=16).collect()}
    assert counted_small == counted
    assert decontam.find_leaks(empty, benchmark).count() == 0
    assert decontam.find_leaks(awkward, benchmark.limit(0)).count() == 0
    assert {r.n_items for r in decontam.count_leaks(awkward, benchmark.limit(0)).collect()} == {0}


def test_walk_keeps_few_edits_close():
    """Equal sequences meet always, edited ones often, others hardly ever."""
    rng = np.random.default_rng(5)
    own = rng.integers(1, 1 << 60, (300, 40), dtype=np.uint64)
    near = own.copy()
    near[:, 30] = 7
    far = rng.integers(1, 1 << 60, (300, 40), dtype=np.uint64)
    lengths = np.full(300, 40)
    share = lambda other: np.mean([
        (decontam.walk(own, lengths, s, 3) == decontam.walk(other, lengths, s, 3)).mean() for s in range(8)
    ])
    assert share(own) == 1 and share(near) > 0.4 and share(far) < 0.05
    wider = np.column_stack([own, np.zeros((300, 13), np.uint64)])
    assert (decontam.walk(own, lengths, 3, 3) == decontam.walk(wider, lengths, 3, 3)).all()


def test_recall_target_sets_the_repetitions():
    array = pa.array([" ".join(f"w{i}x{j}" for j in range(30)) for i in range(50)], pa.large_string())
    few = decontam.Items(list(range(50)), array, 0.2, 3, 0.5)
    many = decontam.Items(list(range(50)), array, 0.2, 3, 0.99)
    assert 1 <= len(few.keys) < len(many.keys) <= decontam.MAX_REPEATS
