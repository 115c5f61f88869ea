"""Benchmark decontamination: passages of documents within a small edit distance of a benchmark item.

Texts are sequences of words (lower case, punctuation dropped) and distances count
word edits. A document holds an item of n words if some stretch of it is within
``floor(share * n)`` edits of the item.

1. An item is cut into one more pieces than edits are allowed, so that every such
   stretch holds one piece unchanged. Pieces found in a document give the places of
   item-sized windows; all other places are out of reach and cost nothing more.
2. Windows and items go through the same random walks of Chakraborty, Goldenberg and
   Koucky, which turn few edits into few differing positions. Each repetition samples
   some positions as a key; windows and items that share a key in any repetition are
   candidates. The number of repetitions comes from a recall to reach, measured on
   randomly edited items.
3. Candidates are verified by the exact edit distance of the item to the window with
   as many words around it as edits are allowed.

The items are few beside the documents: they go to the tasks in blocks of bounded
size, one pass per block. Documents only flow through, nothing is shuffled.

Defined results: null and empty texts, and items without a word, are in no result;
equal items are reported each; a document row with an identifier used twice is
reported twice; of several stretches of one item in a document the best is
reported, the first among equals. Empty tables give no rows; other columns are not
read.
"""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from stowage.llm.kernels import Rolling, blocks, mix, runs, texts
from stowage.llm.tables import ID, TEXT, map_texts

EDIT_SHARE = 0.2
RECALL = 0.99
SAMPLED = 3  # positions that make a key
MAX_REPEATS = 48
ITEM_BYTES = 32 << 20  # text of the items that go to the tasks at once

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def words(array: pa.Array):
    """For each block: first document, hashes of all words, and where each document starts among them."""
    for first, _, data, offsets in blocks(pc.utf8_lower(array)):
        starts, ends, bounds = runs(_WORD[data], offsets)
        yield first, Rolling(data).of(starts, ends), bounds


def _padded(parts: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(parts), width), np.uint64)
    for row, part in zip(out, parts):
        row[: len(part)] = part
    return out


def walk(sequences: np.ndarray, lengths: np.ndarray, seed: int, sampled: int) -> np.ndarray:
    """One repetition: the walk over each (zero-padded) sequence, and the key of its sampled positions.

    Positions are sampled as shares of three times the length, so that a sequence and
    an item of nearly its length compare nearly the same places.
    """
    rng = np.random.default_rng(seed)
    rows, width = np.arange(len(sequences)), sequences.shape[1]
    chosen = np.floor(rng.random(sampled) * 3 * lengths[:, None]).astype(np.int64)
    signs = rng.integers(0, 1 << 63, 3 * width, dtype=np.uint64)  # drawn last: the width differs between calls
    keys = np.full(len(sequences), seed, np.uint64)
    extended = np.column_stack([sequences, np.zeros(len(sequences), np.uint64)])
    at = np.zeros(len(sequences), np.int64)
    for step in range(int(chosen.max(initial=-1)) + 1):
        symbol = extended[rows, at]
        for hit in (chosen == step).T:
            keys[hit] = mix(keys[hit] * np.uint64(0x9E3779B97F4A7C15) + symbol[hit])
        spread = (symbol ^ signs[step]) * np.uint64(0xBF58476D1CE4E5B9)
        at = np.minimum(at + ((spread >> np.uint64(47)) & np.uint64(1)).astype(np.int64), width)
    return keys


def edits(items: np.ndarray, lengths: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits between each item and any stretch of its region, and where the first best stretch ends.

    Padding of the regions must differ from every word of the items.
    """
    columns = np.arange(regions.shape[1] + 1)
    row = np.zeros((len(items), len(columns)), np.int32)
    last = row.copy()
    for i in range(int(lengths.max(initial=0))):
        change = row[:, :-1] + (regions != items[:, i : i + 1])
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(change, row[:, 1:] + 1)
        row = np.minimum.accumulate(new - columns, axis=1) + columns
        done = lengths == i + 1
        last[done] = row[done]
    return last.min(axis=1), last.argmin(axis=1)


class Items:
    """The items of one block, with their pieces and the keys of every repetition."""

    def __init__(self, ids: list[int], array: pa.Array, share: float, sampled: int, recall: float):
        parts: list[np.ndarray] = []
        for _, codes, bounds in words(array):
            parts += [codes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        full = [i for i, p in enumerate(parts) if len(p)]
        self.ids = np.array([ids[i] for i in full], np.int64)
        parts = [parts[i] for i in full]
        self.lengths = np.array([len(p) for p in parts], np.int64)
        self.words = _padded(parts, int(self.lengths.max(initial=0)))
        self.allowed = np.floor(share * self.lengths + 1e-9).astype(np.int64)
        self.sampled = sampled
        # Pieces by their length: hash, item, offset in the item.
        by_size: dict[int, list[tuple[int, int, int]]] = {}
        for i, (part, allowed) in enumerate(zip(parts, self.allowed.tolist())):
            size = len(part) // (allowed + 1)
            for k in range(allowed + 1):
                at = k * len(part) // (allowed + 1)
                by_size.setdefault(size, []).append((int(run(part[at : at + size], size)[0]), i, at))
        self.pieces = {}
        for size, found in by_size.items():
            found.sort()
            hashes = np.array([h for h, _, _ in found], np.uint64)
            sieve = np.zeros(1 << 20, bool)
            sieve[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.pieces[size] = (sieve, hashes, np.array([f[1:] for f in found], np.int64))
        self.keys = []
        for seed in range(self._repeats(recall)):
            keys = walk(self.words, self.lengths, seed, sampled)
            order = np.argsort(keys, kind="stable")
            self.keys.append((keys[order], order))

    def _repeats(self, recall: float) -> int:
        """Repetitions that find this share of items edited as much as is allowed."""
        editable = np.flatnonzero(self.allowed > 0)[:400]
        if not len(editable):
            return 1
        rng = np.random.default_rng(7)
        changed = []
        for i in editable:
            part = list(self.words[i, : self.lengths[i]])
            for _ in range(self.allowed[i]):
                kind, at = rng.integers(3), int(rng.integers(len(part)))
                fresh = rng.integers(1, 1 << 62, dtype=np.uint64)
                part[at : at + 1] = ([fresh], [fresh, part[at]], [])[kind]
            changed.append(np.array(part[: self.lengths[i]], np.uint64))
        width = self.words.shape[1]
        lengths = self.lengths[editable]
        windows, own = _padded(changed, width), self.words[editable]
        met = np.zeros(len(editable), bool)
        for seed in range(MAX_REPEATS):
            met |= walk(windows, lengths, seed, self.sampled) == walk(own, lengths, seed, self.sampled)
            if met.mean() >= recall:
                return seed + 1
        return MAX_REPEATS

    def windows(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct (document, start, item length) of the windows that hold a piece in its place."""
        found = []
        for size, (sieve, hashes, owners) in self.pieces.items():
            if len(codes) < size:
                continue
            code = run(codes, size)
            at = np.flatnonzero(sieve[(code >> np.uint64(44)).astype(np.int64)])
            low, high = np.searchsorted(hashes, code[at]), np.searchsorted(hashes, code[at], "right")
            at, low, n = at[high > low], low[high > low], (high - low)[high > low]
            doc = np.searchsorted(bounds, at, "right") - 1
            place = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else n
            item, offset = owners[place, 0], owners[place, 1]
            start = np.repeat(at, n) - offset
            found.append(np.column_stack([np.repeat(doc, n), start, self.lengths[item]]))
        if not found:
            return np.zeros((0, 3), np.int64)
        return np.unique(np.concatenate(found), axis=0)

    def candidates(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct (document, start, item) that share a key in some repetition."""
        windows = self.windows(codes, bounds)
        found = [np.zeros((0, 3), np.int64)]
        for at in range(0, len(windows), 20_000):
            part = windows[at : at + 20_000]
            first, last = bounds[part[:, 0]], bounds[part[:, 0] + 1]
            place = part[:, 1, None] + np.arange(int(part[:, 2].max()))
            inside = (place >= first[:, None]) & (place < last[:, None]) & (place < (part[:, 1] + part[:, 2])[:, None])
            sequences = np.where(inside, codes[np.clip(place, 0, len(codes) - 1)], np.uint64(0))
            for seed, (keys, order) in enumerate(self.keys):
                own = walk(sequences, part[:, 2], seed, self.sampled)
                low, high = np.searchsorted(keys, own), np.searchsorted(keys, own, "right")
                n = high - low
                row = np.repeat(np.arange(len(part)), n)
                if len(row):
                    item = order[np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
                    near = np.abs(self.lengths[item] - part[row, 2]) <= self.allowed[item]
                    found.append(np.column_stack([part[row, 0], part[row, 1], item])[near])
        return np.unique(np.concatenate(found), axis=0)

    def verified(self, candidates: np.ndarray, codes: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], tuple]:
        """The best stretch of each (document, item): edits, start of its window, end, both as words of the document."""
        best: dict[tuple[int, int], tuple] = {}
        for at in range(0, len(candidates), 5000):
            doc, start, item = candidates[at : at + 5000].T
            slack, length = self.allowed[item], self.lengths[item]
            width = int((length + 2 * slack).max())
            place = (start - slack)[:, None] + np.arange(width)
            inside = (place >= bounds[doc][:, None]) & (place < bounds[doc + 1][:, None])
            inside &= np.arange(width) < (length + 2 * slack)[:, None]
            regions = np.where(inside, codes[np.clip(place, 0, len(codes) - 1)], np.uint64(0))
            cost, end = edits(self.words[item], length, regions)
            for i in np.flatnonzero(cost <= slack).tolist():
                own = int(bounds[doc[i]])
                last = int(start[i] - slack[i] + end[i]) - own
                match = (int(cost[i]), max(0, int(start[i]) - own), last)
                key = (int(doc[i]), int(item[i]))
                best[key] = min(best.get(key, match), match)
        return best


def run(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words; runs over the end of a document don't matter, they are verified."""
    n = len(codes) - size + 1
    h = codes[:n].copy()
    for k in range(1, size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[k : n + k]
    return mix(h)


def _scan(array: pa.Array, items):
    shared: Items = items.value
    rows, found = [], []
    for first, codes, bounds in words(array):
        candidates = shared.candidates(codes, bounds)
        for (doc, item), match in sorted(shared.verified(candidates, codes, bounds).items()):
            rows.append(first + doc)
            found.append((int(shared.ids[item]), int(shared.lengths[item]), *match))
    columns = list(zip(*found)) or [()] * 5
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
    return rows, [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]


def _count(array: pa.Array, items):
    rows, _ = _scan(array, items)
    return None, [pa.array(np.bincount(np.array(rows, np.int64), minlength=len(array)).astype(np.int64))]


def _item_blocks(benchmark: DataFrame, share: float, recall: float, sampled: int, item_col: str, item_text_col: str, item_bytes: int):
    """The items in blocks of bounded size, each as a broadcast variable."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    items = items.where("id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    parts = -(-size // item_bytes)
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).orderBy("id", "text").toArrow()
        yield spark.sparkContext.broadcast(Items(own["id"].to_pylist(), texts(own["text"]), share, sampled, recall))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    share: float = EDIT_SHARE,
    recall: float = RECALL,
    sampled: int = SAMPLED,
    id_col: str = ID,
    text_col: str = TEXT,
    item_col: str = "item_id",
    item_text_col: str = TEXT,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """One row for each document and item that it holds: item_id, item_words, edits, start_word, end_word."""
    schema = "item_id bigint, item_words int, edits int, start_word int, end_word int"
    blocks_ = _item_blocks(benchmark, share, recall, sampled, item_col, item_text_col, item_bytes)
    found = [map_texts(docs, partial(_scan, items=items), schema, id_col, text_col) for items in blocks_]
    if not found:
        nothing = T.StructType([docs.select(F.col(id_col).alias(ID)).schema[0], *T.StructType.fromDDL(schema)])
        return docs.sparkSession.createDataFrame([], nothing)
    return reduce(DataFrame.unionByName, found)


def count_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    share: float = EDIT_SHARE,
    recall: float = RECALL,
    sampled: int = SAMPLED,
    id_col: str = ID,
    text_col: str = TEXT,
    item_col: str = "item_id",
    item_text_col: str = TEXT,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """One row per document, in place: doc_id and n_items, the number of items that it holds."""
    rows = docs.select(F.col(id_col).alias("own"), F.col(text_col).alias("body"), F.lit(0).cast("long").alias("n"))
    for items in _item_blocks(benchmark, share, recall, sampled, item_col, item_text_col, item_bytes):
        row = rows.select(F.struct("own", "body", "n").alias("row"), "body")
        counted = map_texts(row, partial(_count, items=items), "more bigint", "row", "body")
        rows = counted.select(f"{ID}.own", f"{ID}.body", (F.col(f"{ID}.n") + F.col("more")).alias("n"))
    return rows.select(F.col("own").alias(ID), F.col("n").alias("n_items"))
