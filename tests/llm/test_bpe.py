"""Byte-pair encoding against the tokenizers library, and against words merged one pair at a time."""

import hashlib
import json
import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from stowage.llm import bpe
from stowage.llm.queries import op13_bpe, tokenizer_path

from conftest import SF


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(tokenizer_path())


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def check(library, encoder, texts):
    ids = encoder.encode(pa.array(texts, pa.large_string()))
    assert ids.to_pylist() == [ids_of(library, t) for t in texts]
    back = bpe.decoded(ids, encoder.vocabulary).to_pylist()
    assert back == [library.decode(i, skip_special_tokens=False) for i in ids.to_pylist()]


def test_mixed_characters(library, vocabulary):
    draw = random.Random(5)
    letters = "aAbB éÉß中文😀\x00\n\t'sStTrReEvVmMlLdD<|endoftext|>!?.,0123½Σσςİﬁ̸́가  \x1c\x1f"
    texts = []
    for _ in range(4000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 40)))
        if draw.random() < 0.3:
            text = text[:9] + "<|endoftext|>" + text[9:] + draw.choice(["<|startoftext|>", "<|ENDOFTEXT|>", "<|endof"])
        texts.append(text)
    check(library, bpe.Encoder(vocabulary), texts)


def test_every_character(library, vocabulary):
    texts = [f"a{c}b {c}{c} A{c}" for c in map(chr, [*range(0xD800), *range(0xE000, 0x11000, 3), *range(0x1F000, 0x1FA00)])]
    check(library, bpe.Encoder(vocabulary), texts)


def test_long_words_pieces_and_forgetting(library, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 64)
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    draw = random.Random(6)
    words = ["".join(draw.choice("etaoin") for _ in range(draw.randint(1, 9))) for _ in range(600)]
    encoder = bpe.Encoder(vocabulary)
    for _ in range(4):
        check(library, encoder, [" ".join(draw.choices(words, k=300)), "a" * 5000, "the" * 900, "", "  \n "])
    assert len(encoder._place) < 2000


def test_a_merge_that_makes_a_pair_of_lower_rank():
    """With tangled ranks, ids are those of words merged one pair, the lowest and first, at a time."""
    draw = random.Random(7)

    class Tangled:
        inner = last = bpe.np.arange(512)
        rank_of = bpe.Vocabulary.rank_of

        def __init__(self):
            made, names = [], {97: "a", 98: "b", 99: "c"}
            while len(made) < 30:
                one, two = draw.choices(list(names), k=2)
                new = next((i for i, name in names.items() if name == names[one] + names[two]), 200 + len(names))
                if (one, two, new) not in made and len(names[one] + names[two]) < 7:
                    made.append((one, two, new))
                    names[new] = names[one] + names[two]
            draw.shuffle(made)
            self.made = made
            self.ranks = {one << bpe._SHIFT | two: rank for rank, (one, two, _) in enumerate(made)}
            self._pairs = bpe.np.sort(bpe.np.array(list(self.ranks)))
            self._of = bpe.np.array([self.ranks[p] for p in self._pairs.tolist()])

    def plain(word, vocabulary):
        ids = [ord(c) for c in word]
        while True:
            pairs = [(vocabulary.ranks.get(a << bpe._SHIFT | b, 1 << 40), n) for n, (a, b) in enumerate(zip(ids, ids[1:]))]
            rank, n = min(pairs, default=(1 << 40, 0))
            if rank == 1 << 40:
                return ids
            ids[n : n + 2] = [vocabulary.made[rank][2]]

    for _ in range(60):
        vocabulary = Tangled()
        words = ["".join(draw.choice("abc") for _ in range(draw.randint(1, 14))) for _ in range(30)]
        ids, counts = bpe.encode_words(words, vocabulary)
        assert ids.tolist() == [i for w in words for i in plain(w, vocabulary)]
        assert counts.sum() == len(ids)


def test_other_models_are_refused(tmp_path):
    with open(tokenizer_path()) as file:
        parts = json.load(file)
    parts["model"]["dropout"] = 0.1
    (tmp_path / "other.json").write_text(json.dumps(parts))
    with pytest.raises(ValueError):
        bpe.Vocabulary(str(tmp_path / "other.json"))
    with pytest.raises(ValueError):  # its words start with white space
        bpe.Vocabulary(tokenizer_path("byte_bpe_50k.json"))


def test_awkward_rows(awkward, library):
    rows = bpe.encode(awkward, tokenizer_path(), both=True).collect()
    texts = {r.doc_id: r.text or "" for r in awkward.select("doc_id", "text").collect()}
    assert len(rows) == awkward.count()
    for r in rows:
        assert r.ids == ids_of(library, texts[r.doc_id])
        assert r.text == library.decode(r.ids, skip_special_tokens=False)


def test_decode(spark, library):
    lists = [(1, [320, 49407, 5]), (2, []), (3, None), (4, [320, -1, 99999, None, 5])]
    rows = spark.createDataFrame(lists, "doc_id long, ids array<int>")
    found = {r.doc_id: r.text for r in bpe.decode(rows, tokenizer_path()).collect()}
    assert found == {1: "a</w> <|endoftext|> &", 2: "", 3: "", 4: "a</w> &"}


def test_empty_table(empty):
    assert bpe.encode(empty, tokenizer_path(), both=True).count() == 0
    assert bpe.decode(bpe.encode(empty, tokenizer_path()), tokenizer_path()).count() == 0


def test_query(spark, documents, library):
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = {r.doc_id: tuple(r)[1:] for r in op13_bpe(spark, SF).collect()}
    for r in documents.collect():
        ids = ids_of(library, r.text or "")
        decoded = library.decode(ids, skip_special_tokens=False)
        assert rows[r.doc_id] == (len(ids), digest(" ".join(map(str, ids))), digest(decoded))
    assert len(rows) == documents.count()
