"""Byte-pair encoding by an index of pair occurrences, and decoding.

The words of a block of texts that a task has not met yet are laid side by side as
symbols. An index maps each pair that has a rank to all its positions; ranks in it are
taken in ascending order, the pair is merged at each of its positions from left to right,
and the lists of the pairs that a merge makes or breaks are updated: new pairs are
appended to the lists of their ranks, and positions whose pair is gone are passed over
when their list comes up. If a merge makes a pair of lower rank, that one comes first.
For every word this is the order in which its merges are due, so ids are those of the
words taken one by one. A task remembers the words it has met, in a table of bounded size.

Cutting at special tokens, normalising and splitting into words is done as the tokenizer's
file says, by the library that defines these steps, for each new stretch between white
space. Files whose words hold white space, or whose models go beyond ranked pairs of
byte-level symbols, are refused.

Defined results: a null or empty text has no ids and decodes to an empty text; rows with
equal or null identifiers are texts of their own; an empty table gives no rows; ids that
the vocabulary lacks are left out in decoding; other columns are not read. A long text is
split piece by piece, cut before white space; nothing is truncated or padded.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from stowage.llm.kernels import texts
from stowage.llm.tables import ID, TEXT, small_batches

REMEMBERED = 300_000  # stretches, and words, that a task remembers before it starts anew
PIECE = 1 << 20  # code points of a long text that are split together
_SHIFT = 21  # ids have fewer bits


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class Vocabulary:
    """What a tokenizer's file says: symbols of bytes, ranks of pairs, special tokens, how texts become words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        known = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        unusual = [k for k in known if model.get(k)]
        if model["type"] != "BPE" or unusual or parts.get("decoder") is not None:
            raise ValueError(f"not a byte-level BPE model as known here: {model['type']} {unusual}")
        ids = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        # symbols of a word, by the code point that stands for a byte; the last one has its own
        self.inner, self.last = np.zeros(512, np.int64), np.zeros(512, np.int64)
        for symbol in _byte_symbols():
            self.inner[ord(symbol)], self.last[ord(symbol)] = ids[symbol], ids[symbol + end]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: pair (two ids in one number) -> its rank, and rank -> its two ids and the one they make
        self.ranks = {ids[a] << _SHIFT | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        self._pairs = np.sort(np.fromiter(self.ranks, np.int64, len(self.ranks)))
        self._of = np.fromiter(map(self.ranks.__getitem__, self._pairs.tolist()), np.int64, len(self._pairs))
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in parts["added_tokens"]):
            raise ValueError("special tokens must be plain strings of the text")
        tokens = {i: s for s, i in {**ids, **self.special}.items()}
        self.tokens = pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.string())
        longest_first = sorted(self.special, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self._read_steps(parts)

    def _read_steps(self, parts: dict) -> None:
        from tokenizers import Tokenizer

        steps = {**parts, "added_tokens": [], "model": {**parts["model"], "vocab": {}, "merges": []}}
        steps = Tokenizer.from_str(json.dumps(steps))
        self._normal, self._split = steps.normalizer, steps.pre_tokenizer
        spaced, space = "a 1\t!\n \u00a0.", _byte_symbols()[32]
        together, sizes = self.words(spaced.split())
        if any(space in w for w in together) or sizes.tolist() != [1, 1, 1, 1]:
            raise ValueError("only files whose words end at white space are known here")

    def words(self, stretches: list[str]) -> tuple[list[str], np.ndarray]:
        """The words of some stretches, and how many each has."""
        joined = " ".join(stretches)
        joined = self._normal.normalize_str(joined) if self._normal else joined
        found = self._split.pre_tokenize_str(joined)
        spaces = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le"), np.uint32) == 32)
        if len(spaces) != len(stretches) - 1:
            raise ValueError("only files whose words end at white space are known here")
        starts = np.fromiter((at for _, (at, _) in found), np.int64, len(found))
        return [word for word, _ in found], np.bincount(np.searchsorted(spaces, starts), minlength=len(stretches))

    def rank_of(self, pairs: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 for those without one."""
        at = np.minimum(np.searchsorted(self._pairs, pairs), len(self._pairs) - 1)
        return np.where(self._pairs[at] == pairs, self._of[at], -1)

    def stretches(self, text: str) -> Iterator[list[str | int]]:
        """Piece by piece, the stretches between white space in order; special tokens as their ids."""
        # every second part is a special token
        for n, part in enumerate(self._cut.split(text) if self._cut else [text]):
            if n % 2:
                yield [self.special[part]]
            else:
                for piece in _pieces(part):
                    # four control characters end a stretch for Python, but not for the file's steps
                    yield [s for s in _GAPS.split(piece) if s] if _FALSE_GAPS.search(piece) else piece.split()


# The code points with the property White_Space.
_GAPS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_FALSE_GAPS = re.compile("[\x1c-\x1f]")


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces of about ``PIECE`` code points, each but the first starting with white space."""
    at = 0
    while len(text) - at > PIECE:
        gap = _GAPS.search(text, at + PIECE)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:] if at else text


def encode_words(words: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words (byte-level symbols) one after another, and how many each has, by the index of pair occurrences."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    closing = np.cumsum(sizes) - 1
    symbol = vocabulary.inner[data]
    symbol[closing] = vocabulary.last[data[closing]]
    after = np.arange(1, len(data) + 1)
    after[closing] = -1
    before = np.arange(-1, len(data) - 1)
    before[closing[:-1] + 1] = -1

    # The index: rank -> positions of its pair, at first those of neighbouring bytes.
    ranks = np.full(len(data), -1, np.int64)
    ranks[:-1] = vocabulary.rank_of(symbol[:-1] << _SHIFT | symbol[1:])
    ranks[closing] = -1
    places = np.flatnonzero(ranks >= 0)
    places = places[np.argsort(ranks[places], kind="stable")]
    cuts = np.flatnonzero(np.diff(ranks[places])) + 1
    index = {int(ranks[part[0]]): part.tolist() for part in np.split(places, cuts) if len(part)}

    symbol, after, before = symbol.tolist(), after.tolist(), before.tolist()
    _merge(symbol, after, before, index, vocabulary)
    left = np.array(symbol, np.int64)
    alive = left >= 0
    counts = np.diff(np.concatenate([[0], np.cumsum(alive)[closing]])) if len(words) else np.zeros(0, np.int64)
    return left[alive].astype(np.int32), counts


def _merge(symbol: list[int], after: list[int], before: list[int], index: dict, vocabulary: Vocabulary) -> None:
    """Merge in place; positions that are merged away hold -1."""
    rank_of, made = vocabulary.ranks.get, vocabulary.made
    active = list(index)
    heapq.heapify(active)
    while active:
        rank = heapq.heappop(active)
        positions = index.pop(rank)
        positions.sort()
        one, two, new = made[rank]
        for n, at in enumerate(positions):
            right = after[at]
            # passed over if the pair that stood here is gone
            if right < 0 or symbol[at] != one or symbol[right] != two:
                continue
            symbol[at], symbol[right] = new, -1
            beyond = after[at] = after[right]
            left = before[at]
            lower = False
            if beyond >= 0:
                before[beyond] = at
                other = rank_of(new << _SHIFT | symbol[beyond])
                if other is not None:
                    lower = other < rank
                    if other in index:
                        index[other].append(at)
                    else:
                        index[other] = [at]
                        heapq.heappush(active, other)
            if left >= 0:
                other = rank_of(symbol[left] << _SHIFT | new)
                if other is not None:
                    lower |= other < rank
                    if other in index:
                        index[other].append(left)
                    else:
                        index[other] = [left]
                        heapq.heappush(active, other)
            if lower:  # that pair is due before the others of this rank
                if rank in index:
                    index[rank] += positions[n + 1 :]
                elif n + 1 < len(positions):
                    index[rank] = positions[n + 1 :]
                    heapq.heappush(active, rank)
                break


class _Lists:
    """Lists of ids one after another, numbered as they are added."""

    def __init__(self):
        self._ids, self._ends, self._used, self._lists = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), 0, 0

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self._ids = _with_room(self._ids, self._used + len(ids))
        self._ids[self._used : self._used + len(ids)] = ids
        self._ends = _with_room(self._ends, self._lists + len(counts) + 1)
        self._ends[self._lists + 1 : self._lists + len(counts) + 1] = self._used + np.cumsum(counts)
        self._used, self._lists = self._used + len(ids), self._lists + len(counts)

    def gather(self, chosen: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chosen lists one after another, and how many each group of ``sizes`` lists has."""
        starts = self._ends[chosen]
        counts = self._ends[chosen + 1] - starts
        ends = np.concatenate([[0], np.cumsum(counts)])
        flat = self._ids[np.repeat(starts - ends[:-1], counts) + np.arange(ends[-1])]
        return flat, np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])


def _with_room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


class Encoder:
    """Encodes texts, and remembers the stretches met, at most about ``REMEMBERED`` of them, and their words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self._word, self._words = {}, _Lists()
        self._place, self._stretches = {}, _Lists()
        # special tokens stand as their ids among the stretches
        special = list(self.vocabulary.special.values())
        self._place.update(zip(special, range(len(special))))
        self._stretches.add(np.array(special, np.int32), np.ones(len(special), np.int64))

    def _learn(self, stretches: list[str]) -> None:
        words, sizes = self.vocabulary.words(stretches)
        number = self._word
        new = [w for w in dict.fromkeys(words) if w not in number]
        number.update(zip(new, range(len(number), len(number) + len(new))))
        self._words.add(*encode_words(new, self.vocabulary))
        chosen = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        ids, counts = self._words.gather(chosen, sizes)
        self._place.update(zip(stretches, range(len(self._place), len(self._place) + len(stretches))))
        self._stretches.add(ids, counts)

    def _slots(self, pieces: list[list[str | int]]) -> np.ndarray:
        # the ids of special tokens are there from the start
        met = [s for piece in pieces for s in piece]
        new = [s for s in dict.fromkeys(met) if s not in self._place]
        if new:
            self._learn(new)
        return np.fromiter(map(self._place.__getitem__, met), np.int64, len(met))

    def encode(self, column: pa.Array) -> pa.LargeListArray:
        if max(len(self._place), len(self._word)) > REMEMBERED:
            self._forget()
        slots, sizes, pieces, held = [], [], [], 0
        for text in column.to_pylist():
            size = 0
            for piece in self.vocabulary.stretches(text):
                pieces.append(piece)
                size += len(piece)
                held += len(piece)
                if held > PIECE // 4:
                    slots.append(self._slots(pieces))
                    pieces, held = [], 0
            sizes.append(size)
        slots.append(self._slots(pieces))
        ids, counts = self._stretches.gather(np.concatenate(slots), np.array(sizes, np.int64))
        offsets = np.concatenate([[0], np.cumsum(counts)])
        return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(ids, pa.int32()))


def decoded(ids: pa.LargeListArray, vocabulary: Vocabulary) -> pa.Array:
    """The tokens of each list, joined by one space."""
    flat, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    known = (flat >= 0) & (flat < len(vocabulary.tokens))
    tokens = vocabulary.tokens.take(pa.array(np.where(known, flat, 0), pa.int64()))
    known &= tokens.is_valid().to_numpy(zero_copy_only=False)
    if not known.all():
        offsets = np.concatenate([[0], np.cumsum(known)])[offsets]
        tokens = tokens.filter(pa.array(known))
    none, space = (pa.scalar(part, pa.large_string()) for part in ("", " "))
    spaced = pc.binary_join_element_wise(tokens.cast(pa.large_string()), none, space)
    _, places, data = spaced.buffers()
    places = np.frombuffer(places, np.int64)[spaced.offset :][: len(spaced) + 1]
    data = np.frombuffer(data, np.uint8) if len(spaced) else np.zeros(0, np.uint8)
    # a space follows each token; after the last one of a list it goes
    filled = offsets[1:] > offsets[:-1]
    bounds = places[offsets] - np.concatenate([[0], np.cumsum(filled)])
    joined = np.delete(data, places[offsets[1:][filled]] - 1)
    return pa.LargeStringArray.from_buffers(len(filled), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(joined))


def _lists(column: pa.Array) -> pa.LargeListArray:
    """A column of lists without nulls, from the first offset on."""
    column = column.cast(pa.large_list(pa.int32()))
    sizes = pc.coalesce(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pc.list_flatten(column).fill_null(-1))


def _encode(batches: Iterator[pa.RecordBatch], path: str, both: bool) -> Iterator[pa.RecordBatch]:
    encoder = None
    for batch in batches:
        encoder = encoder or Encoder(Vocabulary(path))
        ids = encoder.encode(texts(batch.column(1)))
        columns = [batch.column(0), ids.cast(pa.list_(pa.int32()))]
        names = [ID, "ids"]
        if both:
            columns.append(decoded(ids, encoder.vocabulary).cast(pa.string()))
            names.append(TEXT)
        yield pa.RecordBatch.from_arrays(columns, names)


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    vocabulary = None
    for batch in batches:
        vocabulary = vocabulary or Vocabulary(path)
        text = decoded(_lists(batch.column(1)), vocabulary).cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), text], [ID, TEXT])


def encode(docs: DataFrame, path: str, id_col: str = ID, text_col: str = TEXT, both: bool = False) -> DataFrame:
    """doc_id and ids (an array of int) of each text; with ``both``, also the text they decode to.

    ``path`` names a tokenizer's file that all executors can read.
    """
    small_batches(docs.sparkSession)
    kept = docs.select(F.col(id_col).alias(ID), F.col(text_col).cast("string").alias(TEXT))
    fields = [kept.schema[0], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if both:
        fields.append(T.StructField(TEXT, T.StringType()))
    return kept.mapInArrow(partial(_encode, path=path, both=both), T.StructType(fields))


def decode(encoded: DataFrame, path: str, id_col: str = ID, ids_col: str = "ids") -> DataFrame:
    """doc_id and text of each list of ids: its tokens, special ones too, joined by one space."""
    kept = encoded.select(F.col(id_col).alias(ID), F.col(ids_col).cast("array<int>").alias("ids"))
    fields = [kept.schema[0], T.StructField(TEXT, T.StringType())]
    return kept.mapInArrow(partial(_decode, path=path), T.StructType(fields))
