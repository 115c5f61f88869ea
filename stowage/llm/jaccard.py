"""N-gram Jaccard self-join by count vectors in an R-tree, and the groups of its links.

A text's set is that of its distinct n-word shingles. Equal sets become one class
first. Classes can only be linked if they share one of their first few shingles in
an order that all of them follow (the shingles that turned up often in some task come
last), so these are the groups in which candidates are sought. Within a group, the
shingles of each set are hashed to coordinates whose counts make a point; points
are kept in an R-tree, and the sum of the smaller counts of two boxes or points
bounds the overlap from above. Pairs that pass are verified on the whole sets.

Pairs whose classes are already connected aren't verified: first each class meets its
most promising partner, everywhere. Of the pairs that may still join two components, those
of groups that have few are verified as pairs. A group where more than ``DENSE`` members
have such pairs is gathered again with their whole sets (of groups with the same such members,
one); there each link joins two components, and only such links leave the group. So
no more than a fixed number of rows for each member leaves a group, however many pairs there are.
Groups are gathered in buckets of bounded size; a crowded group is dealt into blocks
and each pair of blocks is one piece of work.

Defined results: null and empty texts have the empty set and are linked with
nothing; with fewer than n words the whole text is one shingle; rows with equal
texts are of one component, whatever their identifiers; rows without an identifier
take part but don't name components; a component without any identifier is named by
null; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from stowage.llm.kernels import Rolling, blocks, mix, runs, shingles, texts
from stowage.llm.tables import ID, TEXT, bound, map_texts, scratch, small_batches
from stowage.operators.components import components

GROUPS = 256  # coordinates of a point
LEAF = 64  # points in a leaf of the R-tree
FREQUENT = 1 << 18  # shingles that are known to be frequent; others count as rare
TALLY = 1 << 21  # shingles that a task tallies at once
BUCKET_ROWS = 200_000  # prefix shingles of one bucket
GROUP_ROWS = 20_000  # rows of one bucket of candidate groups
PAIR_ROWS = 2000  # pairs of one bucket, about
BLOCK_ROWS = 2048  # members of a crowded group that meet at once
DENSE = 32  # members with open pairs, beyond which a group verifies these itself
SETS_BYTES = 32 << 20  # whole sets of one bucket, about
IDS_BYTES = 16 << 20  # identifiers that may go to all tasks

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _sets(array: pa.Array, n: int) -> Iterator[np.ndarray]:
    for _, _, data, offsets in blocks(array):
        data = _LOWER[data]
        starts, ends, bounds = runs(~_SPACE[data], offsets)
        yield from shingles(Rolling(data).of(starts, ends), bounds, n)


def _signature(members: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    other = mix(members ^ np.uint64(0xA0761D6478BD642F))
    return np.array([members.sum(), other.sum()], np.uint64).tobytes()


def _short(signature: bytes) -> int:
    return int(np.frombuffer(signature, np.int64)[1])


def _point(members: np.ndarray) -> bytes:
    """How many members of a set fall on each coordinate, in as few bytes as the largest count takes."""
    counts = np.bincount((members >> np.uint64(56)).astype(np.int64), minlength=GROUPS)
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def _counts(point: bytes) -> np.ndarray:
    return np.frombuffer(point, f"<u{len(point) // GROUPS}")


def _profile(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """A row for each text with the point of its set, and rows for shingles that several texts of the task have."""
    names = ["doc_id", "n_shingles", "signature", "owner", "point", "shingle", "texts"]
    held, size, kind = [], 0, None

    def tally() -> pa.RecordBatch:
        codes, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64),) * 2
        codes, counts = codes[counts > 1], counts[counts > 1]
        nothing = [pa.nulls(len(codes), t) for t in (kind, pa.int64(), pa.binary(), pa.int64(), pa.binary())]
        return pa.RecordBatch.from_arrays([*nothing, pa.array(codes.view(np.int64)), pa.array(counts.astype(np.int64))], names)

    for batch in batches:
        kind = batch.schema.field(0).type
        sizes, signatures, points = [], [], []
        for members in _sets(texts(batch.column(1)), n):
            sizes.append(len(members))
            signatures.append(_signature(members))
            points.append(_point(members))
            held.append(members)
            size += len(members)
            if size >= TALLY:
                yield tally()
                held, size = [], 0
        owners = [_short(s) for s in signatures]
        found = [pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), pa.array(owners, pa.int64())]
        found.append(pa.array(points, pa.binary()))
        yield pa.RecordBatch.from_arrays([batch.column(0), *found, *[pa.nulls(len(sizes), pa.int64())] * 2], names)
    if held:
        yield tally()


def _prefix(members: np.ndarray, frequent: np.ndarray, similar: int, of: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of a set, one of which any similar set has among its own; and which of them are frequent."""
    length = len(members) - -(-similar * len(members) // of) + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, members), len(frequent) - 1)
        often = frequent[at] == members
    else:
        often = np.zeros(len(members), bool)
    order = np.concatenate([np.flatnonzero(~often), np.flatnonzero(often)])[:length]
    return members[order], often[order]


def _prefixes(
    batches: Iterator[pa.RecordBatch], n: int, similar: int, of: int, frequent: Broadcast, buckets: int
) -> Iterator[pa.RecordBatch]:
    """Prefix shingles with the short signature of their set, as one blob per bucket.

    Buckets from 0 up are for rare shingles, by value; frequent ones need not be
    counted and go to bucket -1.
    """
    for batch in batches:
        codes, owners, often = [], [], []
        for members in _sets(texts(batch.column(0)), n):
            if len(members):
                first, flags = _prefix(members, frequent.value, similar, of)
                codes.append(first)
                often.append(flags)
                owners.append(np.full(len(first), _short(_signature(members)), np.int64))
        if not codes:
            continue
        pairs = np.column_stack([np.concatenate(codes).view(np.int64), np.concatenate(owners)])
        bucket = np.where(np.concatenate(often), -1, (mix(pairs[:, 0].view(np.uint64)) % np.uint64(buckets)).astype(np.int64))
        order = np.argsort(bucket, kind="stable")
        pairs, bucket = pairs[order], bucket[order]
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        parts = np.split(pairs, cuts[1:])
        # so that blobs of one size go through Spark, the rare case of a large one is cut
        rows = [(int(b), p[i : i + 65536].tobytes()) for b, p in zip(bucket[cuts], parts) for i in range(0, len(p), 65536)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "pairs"]
        )


def _pairs(column) -> np.ndarray:
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2)


def _shared(table: pa.Table) -> pa.Table:
    """(shingle, owner) for the shingles of a bucket that several sets have."""
    pairs = np.unique(_pairs(table["pairs"]), axis=0) if table.num_rows else np.zeros((0, 2), np.int64)
    same = pairs[1:, 0] == pairs[:-1, 0]
    several = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(pairs) else np.zeros(0, bool)
    pairs = pairs[several]
    return pa.table({"shingle": pairs[:, 0].copy(), "owner": pairs[:, 1].copy()})


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = _pairs(batch.column(1))
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["shingle", "owner"])


def _members(array: pa.Array, n: int):
    """Each set as a whole, with its signature."""
    sets = list(_sets(array, n))
    signatures = [_signature(members) for members in sets]
    return None, [
        pa.array(signatures, pa.binary()),
        pa.array([_short(s) for s in signatures], pa.int64()),
        pa.array([members.tobytes() for members in sets], pa.binary()),
    ]


class Tree:
    """The leaves of an R-tree in bulk: points split at the median of their widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.leaves: list[np.ndarray] = []
        stack = [np.arange(len(points))]
        while stack:
            rows = stack.pop()
            if len(rows) <= LEAF:
                self.leaves.append(rows)
                continue
            own = points[rows]
            widest = int((own.max(axis=0) - own.min(axis=0)).argmax())  # counts: the difference is not negative
            order = np.argsort(own[:, widest], kind="stable")
            stack += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
        self.corners = np.array([points[leaf].max(axis=0) for leaf in self.leaves])
        self.least = np.array([sizes[leaf].min() for leaf in self.leaves])
        self.most = np.array([sizes[leaf].max() for leaf in self.leaves])

    def near(self, similar: int, of: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of leaves whose boxes may hold linked points."""
        for i in range(len(self.leaves)):
            bound = np.minimum(self.corners[i], self.corners[i:]).sum(axis=1, dtype=np.int64)
            enough = bound * (of + similar) >= similar * (self.least[i] + self.least[i:])
            enough &= (self.most[i:] * of >= self.least[i] * similar) & (self.most[i] * of >= self.least[i:] * similar)
            for j in np.flatnonzero(enough).tolist():
                yield self.leaves[i], self.leaves[i + j]


def _candidates(
    points: np.ndarray, sizes: np.ndarray, component: np.ndarray, block: np.ndarray, similar: int, of: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of unconnected points whose bound on the overlap is enough, and the slack of the bound.

    Points of a crowded group are of one block or two; of two, only pairs across count.
    """
    found = []
    across = len(np.unique(block)) > 1
    tree = Tree(points, sizes)
    for one, other in tree.near(similar, of):
        bound = np.minimum(points[one][:, None, :], points[other][None, :, :]).sum(axis=2, dtype=np.int64)
        a, b = sizes[one][:, None], sizes[other][None, :]
        slack = bound * (of + similar) - similar * (a + b)
        good = (slack >= 0) & (a * of >= b * similar) & (b * of >= a * similar)
        good &= component[one][:, None] != component[other][None, :]
        if across:
            good &= block[one][:, None] != block[other][None, :]
        i, j = np.nonzero(good)
        # the slack as a share, so that small and large sets compare
        found.append((one[i], other[j], slack[i, j] / (a[i, 0] + b[0, j])))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    a, b, slack = (np.concatenate(c) for c in zip(*found))
    once = np.minimum(a, b) * len(points) + np.maximum(a, b)
    _, first = np.unique(once, return_index=True)
    return a[first], b[first], slack[first]


def _groups(table: pa.Table) -> Iterator[np.ndarray]:
    """The rows of each group of a bucket."""
    ids = np.column_stack([table[c].to_numpy() for c in ("shingle", "low", "high")])
    _, group = np.unique(ids, axis=0, return_inverse=True)
    group = group.ravel()
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1]]))
    yield from np.split(order, cuts[1:])


def _outlines(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Points (in the widest type of the bucket), sizes, components and blocks of the rows of a bucket."""
    _, component = np.unique(np.array(table["component"].to_pylist(), object), return_inverse=True)
    points = np.array([_counts(p) for p in table["point"].to_pylist()])
    return points, table["n_shingles"].to_numpy(), component, table["block"].to_numpy()


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("slack", pa.float64())])


def _seek(table: pa.Table, similar: int, of: int) -> pa.Table:
    """The best candidate of each member of the groups of a bucket."""
    table = table.combine_chunks()
    if not table.num_rows:
        return _FOUND.empty_table()
    owner = table["owner"].to_numpy()
    points, sizes, component, block = _outlines(table)
    out = []
    for rows in _groups(table):
        if (component[rows] == component[rows[0]]).all():
            continue
        a, b, slack = _candidates(points[rows], sizes[rows], component[rows], block[rows], similar, of)
        if not len(a):
            continue
        # Each pair is seen from both ends; either end may choose it.
        this, that, gain = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([slack, slack])
        ranked = np.lexsort((that, -gain, this))
        this, that, gain = this[ranked], that[ranked], gain[ranked]
        best = np.concatenate([[True], this[1:] != this[:-1]])
        out.append((owner[rows[this[best]]], owner[rows[that[best]]], gain[best]))
    if not out:
        return _FOUND.empty_table()
    return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=_FOUND)


_OPEN = ["shingle", "owner", "block", "low", "high", "signature", "component"]


def _still_open(table: pa.Table, similar: int, of: int, dense: int) -> pa.Table:
    """Pairs of the groups of a bucket that may join two components (owner, partner); of dense groups, their members."""
    table = table.combine_chunks()
    pairs, members, digests = [np.zeros((2, 0), np.int64)], [np.zeros(0, np.int64)], [np.zeros((2, 0), np.uint64)]
    if table.num_rows:
        owner = table["owner"].to_numpy().view(np.uint64)
        points, sizes, component, block = _outlines(table)
        for rows in _groups(table):
            if (component[rows] == component[rows[0]]).all():
                continue
            a, b, _ = _candidates(points[rows], sizes[rows], component[rows], block[rows], similar, of)
            open_ = np.unique(np.concatenate([a, b]))
            if len(open_) > dense:
                members.append(rows[open_])
                whose = mix(owner[rows[open_]] + mix(block[rows[open_]].astype(np.uint64)))
                digest = np.array([whose.sum(), mix(whose).sum()], np.uint64)
                digests.append(np.repeat(digest[:, None], len(open_), axis=1))
            else:
                pairs.append(np.stack([rows[a], rows[b]]))
    pairs, members = np.concatenate(pairs, axis=1), np.concatenate(members)
    out = table.select(_OPEN).take(pa.array(np.concatenate([pairs[0], members])))
    partner = table["owner"].to_numpy()[pairs[1]] if table.num_rows else np.zeros(0, np.int64)
    partners = pa.chunked_array([pa.array(partner, pa.int64()), pa.nulls(len(members), pa.int64())])
    out = out.append_column("partner", partners)
    for name, values in zip(("x", "y"), np.concatenate(digests, axis=1).view(np.int64)):
        out = out.append_column(name, pa.chunked_array([pa.nulls(len(partner), pa.int64()), pa.array(values)]))
    return out


def _overlaps(one: int, others: np.ndarray, codes: np.ndarray, offsets: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """How many members a set shares with each of some others; sets are stretches of ``codes``."""
    own = codes[offsets[one] : offsets[one + 1]]
    mark[own] = True
    lengths = offsets[others + 1] - offsets[others]
    ends = np.cumsum(lengths)
    place = np.repeat(offsets[others] - (ends - lengths), lengths) + np.arange(ends[-1])
    shared = np.add.reduceat(mark[codes[place]].astype(np.int64), ends - lengths)
    mark[own] = False
    return shared


def _join_within(table: pa.Table, similar: int, of: int) -> pa.Table:
    """Links between components in the groups of a bucket, verified on whole sets; none that closes a circle there."""
    table = table.combine_chunks()
    if not table.num_rows:
        return _LINKS.empty_table()
    signature, block = table["signature"].to_pylist(), table["block"].to_numpy()
    _, component = np.unique(np.array(table["component"].to_pylist(), object), return_inverse=True)
    links = []
    for rows in _groups(table):
        sets = [np.frombuffer(table["members"][int(r)].as_buffer(), np.uint64) for r in rows]
        sizes = np.array([len(s) for s in sets])
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(int(codes.max()) + 1, bool)
        label = component[rows].copy()
        counts = np.array([np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=GROUPS) for s in sets])
        a, b, _ = _candidates(counts, sizes, label, block[rows], similar, of)
        a, b = np.minimum(a, b), np.maximum(a, b)
        cuts = np.searchsorted(a, np.arange(len(rows) + 1))  # pairs come in the order of both
        for one in np.flatnonzero(np.diff(cuts)).tolist():
            others = b[cuts[one] : cuts[one + 1]]
            others = others[label[others] != label[one]]
            if not len(others):
                continue
            shared = _overlaps(one, others, codes, offsets, mark)
            union = sizes[one] + sizes[others] - shared
            for other in others[of * shared >= similar * union].tolist():
                if label[other] != label[one]:
                    links.append((signature[rows[one]], signature[rows[other]]))
                    label[label == label[other]] = label[one]
    columns = list(zip(*links)) or [(), ()]
    return pa.Table.from_arrays([pa.array(list(c), pa.binary()) for c in columns], schema=_LINKS)


_LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _verify(pairs: pa.Table, sets: pa.Table, similar: int, of: int) -> pa.Table:
    """The linked pairs of a bucket, as signatures; the bucket has each set that its pairs name once."""
    by_owner: dict[int, list] = {}
    for owner, signature, members in zip(sets["owner"].to_pylist(), sets["signature"].to_pylist(), sets["members"]):
        by_owner.setdefault(owner, []).append((signature, np.frombuffer(members.as_buffer(), np.uint64)))
    links = []
    for one, two in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()):
        for first, a in by_owner.get(one, ()):
            for second, b in by_owner.get(two, ()):
                overlap = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
                if of * overlap >= similar * (len(a) + len(b) - overlap):
                    links.append((first, second))
    columns = list(zip(*links)) or [(), ()]
    return pa.Table.from_arrays([pa.array(list(c), pa.binary()) for c in columns], schema=_LINKS)


def near_duplicates(
    docs: DataFrame, n: int = 5, similar: int = 80, of: int = 100, id_col: str = ID, text_col: str = TEXT
) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the least identifier reachable by links.

    Two sets are linked when ``of * intersection >= similar * union``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kept = scratch(spark)
    plain = docs.select(F.col(id_col).alias(ID), F.col(text_col).cast("string").alias(TEXT))
    kind = plain.schema[ID].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles bigint, signature binary, owner bigint, point binary, shingle bigint, texts bigint"
    seen = kept.table(plain.mapInArrow(partial(_profile, n=n), schema), "profile")
    profile = seen.where("signature is not null").select(ID, "n_shingles", "signature", "owner", "point")
    often = seen.where("shingle is not null").groupBy("shingle").agg(F.sum("texts").alias("texts"))
    often = often.orderBy(F.desc("texts"), "shingle").limit(FREQUENT).toArrow()["shingle"].to_numpy().view(np.uint64)
    frequent = spark.sparkContext.broadcast(np.sort(often))

    total = (profile.agg(F.sum("n_shingles")).head()[0] or 0) * (of - similar) // of
    buckets = max(1, -(-total // BUCKET_ROWS))
    kernel = partial(_prefixes, n=n, similar=similar, of=of, frequent=frequent, buckets=buckets)
    passing = scratch(spark)
    blobs = passing.table(plain.select(TEXT).mapInArrow(kernel, "bucket bigint, pairs binary"), "prefixes")
    rare = blobs.where("bucket >= 0").groupBy("bucket").applyInArrow(bound(_shared), "shingle bigint, owner bigint")
    common = blobs.where("bucket < 0").mapInArrow(_unpacked, "shingle bigint, owner bigint").distinct()
    shared = kept.table(rare.unionByName(common), "shared")
    passing.remove()  # the largest table: what is needed of it is in shared

    def sets_of(owners: DataFrame) -> DataFrame:
        """signature, owner and members of some classes, from the text of one row of each."""
        asked = profile.join(owners, "owner", "left_semi").groupBy("signature").agg(F.min(ID).alias("row"))
        asked = kept.table(asked.select("row").distinct(), "rows")
        # two words a row at most, as counted; an identifier of several fields has more
        if asked.count() * (64 if kind.startswith("struct") else 16) <= IDS_BYTES:
            asked = F.broadcast(asked)
        found = plain.join(asked, F.col(ID).eqNullSafe(F.col("row")), "left_semi")
        found = map_texts(found, partial(_members, n=n), "signature binary, owner bigint, members binary").drop(ID)
        # Other texts may have the same identifier, or none.
        found = found.where("length(members) > 0").join(owners, "owner", "left_semi")
        return kept.table(found.dropDuplicates(["signature"]), "sets")

    return _grouped(profile, _connected(kept, shared, profile, sets_of, similar, of))


def _connected(kept, shared: DataFrame, profile: DataFrame, sets_of, similar: int, of: int) -> DataFrame:
    """The component of each signature that is linked with another one."""
    # Copies share many shingles: of groups with the same members, known by two digests, one will do.
    whose = [F.count("*").alias("m"), F.bit_xor(F.xxhash64("owner")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "owner")).alias("y")]
    groups = shared.groupBy("shingle").agg(*whose).where("m > 1")
    crowd = groups.groupBy("m", "x", "y").agg(F.min("shingle").alias("shingle"))
    crowd = crowd.select("shingle", F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("owner"), F.col("blocks")).cast("int")
    members = (
        shared.join(crowd, "shingle")
        .select("shingle", "owner", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("shingle", "owner", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )
    members = kept.table(members, "members")
    buckets = max(1, -(-members.count() // GROUP_ROWS))
    bucket = F.pmod(F.xxhash64("shingle", "low", "high"), F.lit(buckets)).alias("bucket")
    outline = profile.join(members.select("owner").distinct(), "owner", "left_semi").dropDuplicates(["signature"])
    outline = kept.table(outline.select("signature", "owner", "n_shingles", "point"), "outline")
    rows = members.join(outline.withColumn("component", F.col("signature")), "owner")

    def verified(pairs: DataFrame) -> DataFrame:
        """The linked ones of some pairs of owners."""
        sets = sets_of(pairs.select(F.col("a").alias("owner")).union(pairs.select("b")).distinct())
        # Buckets by the digests of both sides: a set goes to as many as a side has, however many pairs it is in.
        side = math.isqrt(pairs.count() // PAIR_ROWS) + 1
        digest = [F.pmod(F.xxhash64(c), F.lit(side)) for c in ("a", "b")]
        dealt = pairs.withColumn("bucket", digest[0] * side + digest[1])
        named = dealt.select("bucket", F.col("a").alias("owner")).union(dealt.select("bucket", "b")).distinct()
        named = named.select(F.col("bucket").alias("of"), "owner")
        new = (
            dealt.groupBy("bucket").cogroup(named.join(sets, "owner").groupBy("of"))
            .applyInArrow(bound(_verify, similar=similar, of=of), "a binary, b binary")
        )
        return kept.table(new, "links")

    def in_order(a: str, b: str) -> list:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    # First the best partner of each class, over all its groups.
    pairs = (
        rows.drop("signature").withColumn("bucket", bucket).groupBy("bucket")
        .applyInArrow(bound(_seek, similar=similar, of=of), "a bigint, b bigint, slack double")
    )
    pairs = pairs.groupBy("a").agg(F.max_by("b", F.struct("slack", "b")).alias("b"))
    tested = kept.table(pairs.select(in_order("a", "b")).distinct().coalesce(buckets), "pairs")
    linked = verified(tested)
    found = components(linked, kept)

    # Then whatever may link two components.
    of_them = found.select(F.col("node").alias("signature"), F.col("component").alias("of"))
    labelled = outline.join(of_them, "signature", "left").withColumn("component", F.coalesce("of", "signature")).drop("of")
    rows = members.join(labelled, "owner").withColumn("bucket", bucket)
    schema = "shingle bigint, owner bigint, block int, low int, high int, signature binary, component binary, partner bigint, x bigint, y bigint"
    still_open = rows.groupBy("bucket").applyInArrow(bound(_still_open, similar=similar, of=of, dense=DENSE), schema)
    still_open = kept.table(still_open.coalesce(buckets), "open")
    pairs = still_open.where("partner is not null").select(in_order("owner", "partner")).distinct()
    pairs = kept.table(pairs.join(tested, ["a", "b"], "left_anti").coalesce(buckets), "pairs")
    new = [] if pairs.isEmpty() else [verified(pairs)]
    dense = still_open.where("partner is null").drop("partner")
    if not dense.isEmpty():
        one = dense.groupBy("x", "y").agg(F.min(F.struct("shingle", "low", "high")).alias("one")).select("one.*")
        dense = kept.table(dense.drop("x", "y").join(one, ["shingle", "low", "high"], "left_semi"), "dense")
        sets = sets_of(dense.select("owner").distinct()).select("signature", "members")
        size = sets.agg(F.sum(F.length("members")) / F.count("*")).head()[0] or 0
        piles = int(dense.count() * size // SETS_BYTES) + 1
        pile = F.pmod(F.xxhash64("shingle", "low", "high"), F.lit(piles))
        whole = dense.join(sets, "signature").withColumn("bucket", pile)
        kernel = bound(_join_within, similar=similar, of=of)
        new.append(kept.table(whole.groupBy("bucket").applyInArrow(kernel, "a binary, b binary"), "links"))
    return components(reduce(DataFrame.unionByName, [linked, *new]), kept) if new else found


def _grouped(profile: DataFrame, found: DataFrame) -> DataFrame:
    # Texts of one set are one class; the classes of a component share its label.
    classes = profile.where("n_shingles > 0").groupBy("signature").agg(F.min(ID).alias("least"))
    labelled = classes.join(found, F.col("signature") == F.col("node"), "left")
    labelled = labelled.select("signature", "least", F.coalesce("component", "signature").alias("component"))
    names = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(names, "component").select("signature", "component_id")
    out = profile.join(named, "signature", "left")
    own = F.when(F.col("n_shingles") == 0, F.col(ID)).otherwise(F.col("component_id"))
    return out.select(ID, "n_shingles", own.alias("component_id"))
