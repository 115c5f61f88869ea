import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stowage.llm import packing
from stowage.llm.queries import op2_packing, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def expected(tokenizer, text, capacity=4096):
    ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
    return [(k, s, len(ids[s : s + capacity]), ids[s : s + capacity].tobytes()) for k, s in enumerate(range(0, len(ids), capacity))]


def test_pieces_equal_the_tokenizer(awkward, documents, tokenizer):
    for docs in (awkward, documents):
        got = defaultdict(list)
        for r in packing.tokenize(docs, tokenizer_path()).collect():
            got[r.doc_id].append((r.piece, r.start, r.length, bytes(r.ids)))
        want = defaultdict(list)
        for r in docs.select("doc_id", "text").collect():
            want[r.doc_id] += expected(tokenizer, r.text)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_query_is_gapless_and_whole(spark, documents, tokenizer):
    rows = op2_packing(spark, SF).collect()
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    want = sorted(
        (r.doc_id, k, s, n, zlib.crc32(ids))
        for r in documents.collect()
        for k, s, n, ids in expected(tokenizer, r.text)
    )
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    least = -(-sum(r.length for r in rows) // 4096)
    assert len(by_sequence) <= least + 1


def test_sequences_hold_the_ids(awkward):
    packed = packing.pack(packing.tokenize(awkward, tokenizer_path(), capacity=512), capacity=512)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


def test_shards_are_numbered_apart(documents):
    pieces = packing.tokenize(documents, tokenizer_path()).drop("ids")
    packed = packing.pack(pieces, shard_pieces=40)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").isEmpty()
    assert packed.count() == pieces.count()


def test_two_for_one():
    # greedy gives 6 with 3 (gap 1); the pair 2 + 2 fills it
    bins, offsets = packing.best_two_fit(np.array([6, 4, 4, 2, 2, 2]), 10)
    filled = np.bincount(bins, [6, 4, 4, 2, 2, 2])
    assert filled.tolist() == [10, 10]
    bins, _ = packing.best_two_fit(np.array([7, 2, 2, 2, 9]), 10)
    assert len(set(bins)) == 3


def test_empty_table(empty):
    assert packing.pack(packing.tokenize(empty, tokenizer_path())).count() == 0


def test_chunks_asked_for_together_are_those_asked_for_singly():
    encoder = packing._Encoder(tokenizer_path())
    odd = ["a<|endoftext|>b", "́abc", " ", "x y", "İstanbul", "it's", "'s", "\U0001f600!!", "\x00", "가"]
    chunks = [c for i in range(60) for c in [*odd, f"w{i},", "q" * i + "."]]
    ids, counts = encoder._ask(chunks)
    single = [e.ids for e in encoder._tokenizer.encode_batch(chunks, add_special_tokens=False)]
    assert ids.tolist() == [i for own in single for i in own] and counts.tolist() == list(map(len, single))
