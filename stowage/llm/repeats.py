"""Removal of long byte strings that occur more than once, anywhere in a corpus.

Every string of ``length`` bytes holds a short gram whose hash is the least of its grams,
the leftmost if several are. Equal strings choose the same gram at the same place, so
only strings with one anchor can be equal. For each anchor of each text the range of
strings that chose it is written down (some 200 bytes apart), not the strings.

Ranges that occur twice as a whole are settled by their hashes. What remains are
ranges that share an anchor and differ: where copies begin, end or were edited.
Their bytes are gathered in buckets by anchor, and the anchors of a bucket, each whole,
get run-length indexes: suffixes are sorted (by doubling, and only those that are still
tied go on), the Burrows-Wheeler transform is cut into its runs, and
the places at the run ends are sampled. The longest match of a suffix with its
neighbour shrinks by one from each place to the next inside a run, so that the
samples give the matching statistics of all places; every match of at least
``length`` marks both of its sides.

An anchor with more than ``CROWD`` different ranges is cut finer before it is indexed: the
strings of a range that have the anchor within ``STEPS[0]`` bytes of one place have most of
their bytes in common, and only ranges that agree in these go on together. Parts that
occur twice as a whole are settled again, so that one of each is indexed. What is still
crowded is cut by smaller steps; with a step of 1 a part is a single string.

Texts are named by a digest of their bytes: repeated rows are one text here, and
all of it is a repeat.

Defined results: null texts are empty; texts shorter than ``length`` stay whole;
strings within one text count like others, overlapping ones too; rows without an
identifier or with one used twice are texts like all others; empty tables give no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stowage.llm.kernels import Rolling, blocks, mix, texts
from stowage.llm.tables import ID, TEXT, bound, scratch, small_batches
from stowage.sources.files import Scratch

LENGTH = 400
GRAM = 32
BUCKET_BYTES = 2 << 20  # text that is dealt out together, on average
INDEX_BYTES = 1 << 17  # text that one run-length index is built over, besides the last anchor's
CROWD = 2048  # ranges of one anchor that go into an index
STEPS = (64, 8, 1)  # places of the anchor that are taken together when a crowded one is cut finer
SHARED_BYTES = 16 << 20  # places that may go to all tasks; beyond that, texts are shuffled to them

_PLACE_BITS = np.uint64(28)  # of a position in a block


def _least(grams: np.ndarray, width: int) -> np.ndarray:
    """Position of the least gram of each window of ``width`` grams, the leftmost if several are."""
    n = len(grams) - width + 1
    place = np.arange(len(grams), dtype=np.uint64)
    keys = (grams >> _PLACE_BITS << _PLACE_BITS) | place
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    table = padded.reshape(-1, width)
    front = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n], front[width - 1 : width - 1 + n])
    return (least & np.uint64((1 << 28) - 1)).astype(np.int64)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by some intervals."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    first = np.ones(len(starts), bool)
    first[1:] = starts[1:] > ends[:-1]
    at = np.flatnonzero(first)
    return starts[at], ends[np.concatenate([at[1:] - 1, [len(ends) - 1]])] if len(at) else ends


def ranges(data: np.ndarray, offsets: np.ndarray, length: int):
    """Anchored ranges of the texts of a block, and the parts of texts that repeat within them.

    Returns rows (text, anchor hash, range hash, first start, last start) and
    (text, start, end), positions counted from the start of the text.
    """
    none = np.zeros((0, 5), np.int64), np.zeros((0, 3), np.int64)
    if len(data) < length:
        return none
    rolling = Rolling(data)
    grams = rolling.every(GRAM)
    anchor = _least(grams, length - GRAM + 1)
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(anchor)]
    start = np.arange(len(anchor))
    valid = start + length <= offsets[owner + 1]

    def cut() -> tuple[np.ndarray, np.ndarray]:
        """First and last start of each run of strings with one anchor."""
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        last = valid.copy()
        last[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
        return np.flatnonzero(new), np.flatnonzero(last)

    first, last = cut()
    # Texts with an anchor twice may repeat themselves: all their strings are compared.
    keys = grams[anchor[first]]
    order = np.lexsort((keys, owner[first]))
    again = (keys[order][1:] == keys[order][:-1]) & (owner[first][order][1:] == owner[first][order][:-1])
    inner = []
    for text in np.unique(owner[first][order[1:][again]]).tolist():
        a, b = int(offsets[text]), int(offsets[text + 1]) - length + 1
        codes = rolling.of(np.arange(a, b), np.arange(a, b) + length)
        _, index, group, counts = np.unique(codes, return_index=True, return_inverse=True, return_counts=True)
        at = np.flatnonzero(counts[group] > 1)
        for s, e in zip(*merged(at, at + length)):
            inner.append((text, s, e))
        later = np.ones(b - a, bool)
        later[index] = False
        valid[a:b] &= ~later
    if inner:
        first, last = cut()
    text = owner[first]
    # a range is known by its bytes and the place of the anchor in it
    code = rolling.of(first, last + length) ^ (anchor[first] - first).astype(np.uint64)
    rows = np.column_stack([
        text, grams[anchor[first]].view(np.int64), code.view(np.int64), first - offsets[text], last - offsets[text],
    ])
    return rows, np.array(inner, np.int64).reshape(-1, 3)


_ROWS = ["text", "anchor", "range", "first", "last"]


def _survey(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Ranges; rows with no anchor are a text as a whole (no range either) or a part that repeats within it."""
    for batch in batches:
        for _, _, data, offsets in blocks(texts(batch.column(0))):
            digests = [hashlib.md5(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:])]
            rows, inner = ranges(data, offsets, length)
            long = np.flatnonzero(np.diff(offsets) >= length)
            text = np.concatenate([rows[:, 0], inner[:, 0], long])
            blank, parts, whole = len(inner) + len(long), len(inner), len(long)
            anchor = pa.concat_arrays([pa.array(rows[:, 1].copy()), pa.nulls(blank, pa.int64())])
            code = pa.concat_arrays([pa.array(rows[:, 2].copy()), pa.array(np.zeros(parts, np.int64)), pa.nulls(whole, pa.int64())])
            first = np.concatenate([rows[:, 3], inner[:, 1], np.zeros(whole, np.int64)])
            last = np.concatenate([rows[:, 4], inner[:, 2], np.diff(offsets)[long]])
            names = pa.array(digests, pa.binary()).take(pa.array(text))
            yield pa.RecordBatch.from_arrays([names, anchor, code, pa.array(first), pa.array(last)], _ROWS)


def _excerpts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the listed ranges of each text."""
    names = ["text", "anchor", "range", "first", "bytes", "members"]
    for batch in batches:
        found = []
        for name, text, wanted in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
            raw = memoryview(text.as_buffer())
            for r in wanted:
                part = bytes(raw[r["first"] : r["last"] + length])
                found.append((name.as_py(), r["anchor"], r["range"], r["first"], part, r["members"]))
        columns = list(zip(*found)) or [()] * 6
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def _in_order(keys: np.ndarray, places: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys in ascending order and their places, which have at most ``bits`` bits."""
    if int(keys.max(initial=0)).bit_length() + bits <= 63:  # sorting numbers takes a fraction of sorting their places
        both = np.sort(keys << bits | places)
        return both >> bits, both & ((1 << bits) - 1)
    order = np.argsort(keys, kind="stable")
    return keys[order], places[order]


def suffix_order(codes: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Places of some strings in a row, sorted by what follows to the end of their string; equal ones by place.

    Codes are small numbers, with a 0 after each string only; ``stops`` has the place of the next 0 from each place on.
    """
    n = len(codes)
    places = np.arange(n)
    bits, width = n.bit_length(), int(codes.max(initial=1)).bit_length()
    # As many codes as fit into a number besides the place make the first key; nothing passes a 0.
    keys, done, room = codes, 1, (63 - bits) // width
    while done < room:
        more = min(done, room - done)
        keys = keys << more * width | keys[np.minimum(places + done, stops)] >> (done - more) * width
        done += more
    keys, order = _in_order(keys, places, bits)
    new = np.ones(n, bool)
    new[1:] = (keys[1:] != keys[:-1]) | (keys[1:] == 0)
    at = places  # where in the order the places stand that are looked at
    ranks = np.empty(n, np.int64)
    while True:
        ranks[order] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        # Only places that share a rank go on, by the rank of what comes ``done`` later.
        tied = ~new
        tied[:-1] |= ~new[1:]
        at, order = at[tied], order[tied]
        if not len(at):
            break
        ahead = ranks[np.minimum(order + done, stops[order])]
        keys, order = _in_order(ranks[order] << bits | ahead, order, bits)
        new = np.ones(len(at), bool)
        new[1:] = keys[1:] != keys[:-1]
        done *= 2
    result = np.empty(n, np.int64)
    result[ranks] = places
    return result


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of some strings, with the places at the run ends."""

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) for s in strings], np.int64)
        self.ends = np.cumsum(sizes + 1)  # after the separator
        self.starts = self.ends - sizes - 1
        data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        known = np.zeros(256, np.int64)
        known[np.unique(data)] = 1
        codes = np.cumsum(known)[data]
        codes[self.ends - 1] = 0  # of separators; no comparison passes one
        self._stops = np.repeat(self.ends - 1, sizes + 1)
        order = suffix_order(codes, self._stops)
        transform = codes[order - 1]
        # separators differ from each other
        heads = np.flatnonzero(np.concatenate([[True], (transform[1:] != transform[:-1]) | (transform[1:] == 0)]))
        self.run_codes = transform[heads]
        self.head_places = order[heads]
        self.end_places = order[heads[1:] - 1]  # of the run before each head but the first
        self._rolling = Rolling(data)

    def _until(self, places: np.ndarray) -> np.ndarray:
        """Bytes from each place to the separator after it."""
        return self._stops[places] - places

    def matches(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of pairs of equal strings at the run ends, and their lengths; each holds all matches inside it."""
        a, b = self.end_places, self.head_places[1:]
        most = np.minimum(self._until(a), self._until(b))
        long = most >= least
        a, b, most = a[long], b[long], most[long]
        same = self._rolling.of(a, a + least) == self._rolling.of(b, b + least)
        a, b, most = a[same], b[same], most[same]
        low = np.full(len(a), least, np.int64)  # equal so far; the length is found by halving
        while (open_ := low < most).any():
            middle = np.where(open_, (low + most + 1) // 2, low)
            equal = self._rolling.of(a, a + middle) == self._rolling.of(b, b + middle)
            low, most = np.where(equal, middle, low), np.where(equal, most, middle - 1)
        return a, b, low


_MARKS = pa.schema([("text", pa.binary()), ("first", pa.int64()), ("last", pa.int64())])


def _pieces(anchors: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of whole anchors, which are in order, of ``INDEX_BYTES`` bytes besides the last anchor's."""
    first = np.searchsorted(anchors, anchors)
    piece = (np.cumsum(sizes) - sizes)[first] // INDEX_BYTES
    cuts = np.flatnonzero(np.diff(piece)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(anchors)]))


def _index(table: pa.Table, length: int) -> pa.Table:
    """Parts of the ranges of a bucket that occur in it more than once, as positions in their texts."""
    if not table.num_rows:
        return _MARKS.empty_table()
    table = table.take(pa.array(np.argsort(table["anchor"].to_numpy(), kind="stable"))).combine_chunks()
    strings, places = table["bytes"].to_pylist(), table["first"].to_numpy()
    sizes = np.array([len(s) for s in strings], np.int64)
    found = []
    for low, high in _pieces(table["anchor"].to_numpy(), sizes):
        index = RunIndex(strings[low:high])
        a, b, size = index.matches(length)
        starts, ends = merged(np.concatenate([a, b]), np.concatenate([a, b]) + np.concatenate([size, size]))
        string = np.searchsorted(index.ends, starts, "right")
        first = places[low + string] + starts - index.starts[string]
        found.append((low + string, first, first + ends - starts))
    string, first, last = (np.concatenate(column) for column in zip(*found))
    names = table["text"].combine_chunks().take(pa.array(string))
    return pa.Table.from_arrays([names, pa.array(first), pa.array(last)], schema=_MARKS)


_PART = "text binary, anchor bigint, `range` bigint, first bigint, bytes binary, pin bigint"


def _finer(batches: Iterator[pa.RecordBatch], length: int, step: int) -> Iterator[pa.RecordBatch]:
    """The parts of ranges whose strings have the anchor at one of ``step`` places, under the bytes all these share."""
    for batch in batches:
        found = []
        columns = [batch.column(n) for n in ("text", "anchor", "first", "bytes", "pin")]
        for name, anchor, first, raw, pin in zip(*columns):
            raw, first = memoryview(raw.as_buffer()), first.as_py()
            rolling = Rolling(np.frombuffer(raw, np.uint8))
            if pin.is_valid:
                at = pin.as_py() - first
            else:  # the least gram of the first string, and of all others
                at = int(_least(rolling.every(GRAM)[: length - GRAM + 1], length - GRAM + 1)[0])
            last = len(raw) - length
            class_ = np.arange((at - last) // step, at // step + 1)
            low, high = np.maximum(0, at - step * (class_ + 1) + 1), np.minimum(last, at - step * class_)
            core = at - step * class_
            shared = rolling.of(core, core + length - step + 1)
            group = mix(shared + mix(np.uint64(anchor.as_py() & (1 << 64) - 1) + class_.astype(np.uint64)))
            code = rolling.of(low, high + length) ^ (at - low).astype(np.uint64)
            for g, c, s, e in zip(group.view(np.int64).tolist(), code.view(np.int64).tolist(), low.tolist(), high.tolist()):
                found.append((name.as_py(), g, c, first + s, bytes(raw[s : e + length]), first + at))
        parts = list(zip(*found)) or [()] * 6
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        names = ["text", "anchor", "range", "first", "bytes", "pin"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(parts, kinds)], names)


def _indexed(excerpts: DataFrame, length: int) -> DataFrame:
    """(text, first, last) of repeated parts of some ranges, by run-length indexes over buckets of whole anchors."""
    size = excerpts.agg(F.sum(F.length("bytes"))).head()[0] or 0
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-size // BUCKET_BYTES))))
    grouped = excerpts.groupBy(bucket.alias("bucket"))
    return grouped.applyInArrow(bound(_index, length=length), "text binary, first bigint, last bigint")


def _crowded_parts(crowded: DataFrame, kept: Scratch, length: int, crowd: int) -> list[DataFrame]:
    """(text, first, last) of repeated parts of the ranges of crowded anchors."""
    marks = []
    for step in STEPS:
        if crowded.isEmpty():
            break
        parts = kept.table(crowded.mapInArrow(partial(_finer, length=length, step=step), _PART), "finer")
        place = F.xxhash64("text", "first")
        counted = parts.groupBy("anchor", "range").agg(F.min(place).alias("low"), F.max(place).alias("high"))
        twice = counted.where("low != high").select("anchor", "range")
        whole = (F.col("first") + F.length("bytes")).alias("last")
        marks.append(parts.join(twice, ["anchor", "range"], "left_semi").select("text", "first", whole))
        if step == 1:
            break
        several = counted.groupBy("anchor").agg(F.count("*").alias("members")).where("members > 1")
        one_each = kept.table(parts.dropDuplicates(["anchor", "range"]).join(several, "anchor"), "one-each")
        marks.append(_indexed(one_each.where(F.col("members") <= crowd), length))
        crowded = one_each.where(F.col("members") > crowd).drop("members")
    return marks


def repeated_parts(docs: DataFrame, length: int = LENGTH, text_col: str = TEXT, crowd: int = CROWD) -> DataFrame:
    """(text, parts): the digest of each text with repeats and its maximal repeated parts, in order."""
    spark = docs.sparkSession
    small_batches(spark)
    kept = scratch(spark)
    plain = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(TEXT))
    seen = kept.table(
        plain.mapInArrow(partial(_survey, length=length), "text binary, anchor bigint, `range` bigint, first bigint, last bigint"),
        "ranges",
    )
    anchored = seen.where("anchor is not null")
    place = F.xxhash64("text", "first")
    by_range = anchored.groupBy("anchor", "range").agg(
        F.min(place).alias("low"), F.max(place).alias("high"), F.min(F.struct("text", "first", "last")).alias("one")
    )
    by_range = kept.table(by_range, "by-range")
    marks = [
        # parts that repeat within a text, and texts that are there twice
        seen.where("anchor is null and `range` is not null").select("text", "first", "last"),
        seen.where("anchor is null and `range` is null").groupBy("text").agg(
            F.min("first").alias("first"), F.min("last").alias("last"), F.count("*").alias("n")
        ).where("n > 1").drop("n"),
        # ranges that are there twice as a whole
        anchored.join(by_range.where("low != high").select("anchor", "range"), ["anchor", "range"], "left_semi")
        .select("text", "first", (F.col("last") + length).alias("last")),
    ]

    # One of each range that shares its anchor with a different one.
    several = by_range.groupBy("anchor").agg(F.count("*").alias("members")).where("members > 1")
    open_ = by_range.join(several, "anchor").select("anchor", "range", "one.*", "members")
    open_ = kept.table(open_, "open")
    wanted = open_.groupBy("text").agg(F.collect_list(F.struct("anchor", "range", "first", "last", "members")).alias("wanted"))
    named = plain.select(F.unhex(F.md5(F.col(TEXT).cast("binary"))).alias("text"), F.col(TEXT).alias("body"))
    if open_.count() * 64 <= SHARED_BYTES:  # four numbers and a digest a row at most
        wanted = F.broadcast(wanted)
    texts_of = named.join(wanted, "text").select("text", "body", "wanted").dropDuplicates(["text"])
    schema = "text binary, anchor bigint, `range` bigint, first bigint, bytes binary, members bigint"
    excerpts = kept.table(texts_of.mapInArrow(partial(_excerpts, length=length), schema), "excerpts")
    marks.append(_indexed(excerpts.where(F.col("members") <= crowd), length))
    crowded = excerpts.where(F.col("members") > crowd).drop("members").withColumn("pin", F.lit(None).cast("long"))
    marks += _crowded_parts(crowded, kept, length, crowd)
    every = marks[0]
    for more in marks[1:]:
        every = every.unionByName(more)

    def step(done, part):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (part["first"] <= F.try_element_at(done, F.lit(-1))["last"])
        wider = F.struct(last["first"].alias("first"), F.greatest(last["last"], part["last"]).alias("last"))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, F.array(part)))

    none = F.array().cast("array<struct<first:bigint,last:bigint>>")
    parts = F.aggregate(F.array_sort(F.collect_set(F.struct("first", "last"))), none, step)
    return kept.table(every.groupBy("text").agg(parts.alias("parts")), "parts")


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    for batch in batches:
        rows = []
        for text, parts in zip(batch.column(1), batch.column(2).to_pylist()):
            raw = memoryview(text.as_buffer())
            if not parts:
                rows.append((len(raw), 0, 0, bytes(raw)))
                continue
            at, kept = 0, []
            for part in parts:
                kept.append(raw[at : part["first"]])
                at = part["last"]
            kept = b"".join([*kept, raw[at:]])
            rows.append((len(raw), len(raw) - len(kept), len(parts), kept))
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]], names)


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = ID, text_col: str = TEXT, crowd: int = CROWD) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and kept, the bytes that remain."""
    parts = repeated_parts(docs, length, text_col, crowd)
    size = parts.agg(F.sum(24 + 16 * F.size("parts"))).head()[0] or 0
    plain = docs.select(F.col(id_col).alias(ID), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    plain = plain.withColumn("text", F.unhex(F.md5(F.col("body").cast("binary"))))
    joined = plain.join(F.broadcast(parts) if size <= SHARED_BYTES else parts, "text", "left").select(ID, "body", "parts")
    kind = joined.schema[ID].dataType.simpleString()
    return joined.mapInArrow(_remove, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
