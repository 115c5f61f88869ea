"""Best-two-fit packing of tokenised documents into sequences of a fixed capacity.

Texts become token ids in one narrow pass; from then on only small rows move.
Pieces are dealt at random into shards of bounded size, each packed on its own:
a bin is filled greedily from the longest piece down, then its smallest piece is
swapped for two unpacked ones that fill the widened gap more tightly, as long as
that gains anything. Shards end with a bin that may be partly empty, one in about
ten thousand.

Defined results: a null or empty text has the single closing token; a document
longer than the capacity is cut into full pieces and a rest; rows with equal or
null identifiers are documents of their own; an empty table gives no rows; other
columns of the documents are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from stowage.llm.kernels import Rolling, blocks, runs
from stowage.llm.tables import ID, TEXT, bound, map_texts, scratch

CAPACITY = 4096
SHARD_PIECES = 25_000  # rows packed together by one task
CLOSING_ID = 1

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Encoder:
    """Token ids of white-space-separated chunks, remembered by hash.

    The vocabulary's rules never join text across white space and drop it, so the
    ids of a text are those of its chunks in turn. A table of fixed size holds the
    chunks seen lately; everything else is asked of the tokenizer.
    """

    SLOTS, POOL, LONGEST, TOGETHER = 1 << 19, 1 << 22, 64, 100

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self._keys = np.zeros(self.SLOTS, np.uint64)
        self._start = np.zeros(self.SLOTS, np.int64)
        self._count = np.zeros(self.SLOTS, np.int32)
        self._pool, self._used = np.zeros(1 << 20, np.int32), 0

    def _add(self, ids: np.ndarray) -> int:
        at, need = self._used, self._used + len(ids)
        if need > len(self._pool):
            self._pool = np.concatenate([self._pool, np.zeros(max(need, len(self._pool)), np.int32)])
        self._pool[at:need] = ids
        self._used = need
        return at

    def _ask(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, and how many each has; they are asked for many at a time, as one text."""
        ids, counts = [], []
        for at in range(0, len(chunks), self.TOGETHER):
            part = chunks[at : at + self.TOGETHER]
            found = self._tokenizer.encode(" ".join(part), add_special_tokens=False)
            ends = np.cumsum([len(chunk) + 1 for chunk in part])
            places = np.fromiter(map(itemgetter(0), found.offsets), np.int64, len(found))
            ids.append(np.array(found.ids, np.int32))
            counts.append(np.bincount(np.searchsorted(ends, places, "right"), minlength=len(part)).astype(np.int32))
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a block, and where each document starts in them."""
        if self._used > self.POOL:
            self._forget()
        data = _LOWER[data]
        starts, ends, bounds = runs(~_SPACE[data], offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        keys = Rolling(data).of(starts, ends) | np.uint64(1)
        slots = (keys >> np.uint64(45)).astype(np.int64)
        start, count = self._start[slots], self._count[slots]
        new = np.flatnonzero(self._keys[slots] != keys)
        if len(new):
            distinct, first, inverse = np.unique(keys[new], return_index=True, return_inverse=True)
            raw, a, b = data.tobytes(), starts[new[first]].tolist(), ends[new[first]].tolist()
            chunks = [raw[i:j].decode() for i, j in zip(a, b)]
            flat, counts = self._ask(chunks)
            at = self._add(flat) + np.cumsum(counts, dtype=np.int64) - counts
            start[new], count[new] = at[inverse], counts[inverse]
            short = np.flatnonzero(ends[new[first]] - starts[new[first]] <= self.LONGEST)
            slot = slots[new[first]][short]
            self._keys[slot] = distinct[short]
            # of two chunks that meet in a slot one stays; all three arrays take the last
            self._start[slot], self._count[slot] = at[short], counts[short]
        closed = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        place = np.repeat(start - closed[:-1], count) + np.arange(closed[-1])
        return self._pool[place], closed[bounds]


class _Pieces:
    """The pieces of texts; the encoder lasts as long as the task."""

    def __init__(self, path: str, capacity: int):
        self._path, self._capacity, self._encoder = path, capacity, None

    def close(self) -> None:
        self._encoder = None

    def __call__(self, array: pa.Array):
        self._encoder = self._encoder or _Encoder(self._path)
        return _pieces(array, self._encoder, self._capacity)


def _pieces(array: pa.Array, encoder: _Encoder, capacity: int):
    rows, piece, start, length, ids = [], [], [], [], []
    for first, _, data, offsets in blocks(array):
        flat, bounds = encoder.encode(data, offsets)
        flat = flat.astype("<u4")
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            own = np.append(flat[a:b], np.uint32(CLOSING_ID))
            for k, at in enumerate(range(0, len(own), capacity)):
                part = own[at : at + capacity]
                rows.append(first + i)
                piece.append(k)
                start.append(at)
                length.append(len(part))
                ids.append(part.tobytes())
    columns = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
    return rows, [*columns, pa.array(ids, pa.binary())]


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: doc_id, piece, start, length and ids (little-endian uint32)."""
    return map_texts(docs, _Pieces(path, capacity), "piece int, start bigint, length bigint, ids binary", id_col, text_col)


def _largest(mask: int, most: int) -> int:
    """The largest length held in the bit mask that is at most ``most``; -1 if there is none."""
    return (mask & ((1 << (most + 1)) - 1)).bit_length() - 1 if most > 0 else -1


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length."""
    order = np.argsort(lengths, kind="stable")
    waiting: dict[int, list[int]] = {}
    for i in order.tolist():
        waiting.setdefault(int(lengths[i]), []).append(i)
    mask = sum(1 << n for n in waiting)
    left = {n: len(w) for n, w in waiting.items()}

    def take(n: int) -> None:
        nonlocal mask
        left[n] -= 1
        if not left[n]:
            mask &= ~(1 << n)

    def give(n: int) -> None:
        nonlocal mask
        left[n] += 1
        mask |= 1 << n

    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    number = 0
    while mask:
        held, gap = [], capacity
        while (n := _largest(mask, gap)) > 0:
            take(n)
            held.append(n)
            gap -= n
        while gap and held and mask:
            room = gap + held[-1]
            best, pair = held[-1], None
            # Of two lengths that fit, the longer one lies between half the room and the room.
            longer = _largest(mask, room - 1)
            while longer > 0 and 2 * longer > best and best < room:
                take(longer)
                other = _largest(mask, min(longer, room - longer))
                give(longer)
                if other > 0 and longer + other > best:
                    best, pair = longer + other, (longer, other)
                longer = _largest(mask, longer - 1)
            if pair is None:
                break
            give(held.pop())
            for n in pair:
                take(n)
            held.extend(pair)
            held.sort(reverse=True)
            gap = room - best
        at = 0
        for n in held:
            i = waiting[n].pop()
            bins[i], offsets[i] = number, at
            at += n
        number += 1
    return bins, offsets


def _pack(pieces: pd.DataFrame, capacity: int) -> pd.DataFrame:
    pieces = pieces.sort_values("_row", kind="stable")
    bins, offsets = best_two_fit(pieces["length"].to_numpy(), capacity)
    # a shard numbers its bins apart from all others
    out = pieces.assign(sequence_id=pieces["_shard"].astype("int64") * (1 << 32) + bins, offset=offsets)
    return out.drop(columns=["_row", "_shard"])


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length`` of 1 to ``capacity``; all their columns stay.

    Within a sequence the offsets run from 0 without gaps.
    """
    spark = pieces.sparkSession
    kept = scratch(spark).table(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-kept.count() // shard_pieces))
    dealt = kept.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("long"))
    schema = T.StructType([*pieces.schema, *T.StructType.fromDDL("sequence_id bigint, offset bigint")])
    return dealt.groupBy("_shard").applyInPandas(bound(_pack, capacity=capacity), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence in order; ``packed`` must have kept the ids of its pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))
