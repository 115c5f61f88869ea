"""Language identification with interpolated Kneser-Ney models of characters.

Character 4-grams of all training texts are counted per language (in each task
first, then summed by Spark). The counts give one interpolated Kneser-Ney model
per language, kept as sorted arrays of n-gram hashes with a row of log
probabilities each, and back-off weights in further arrays of that kind. A text
gets the language of the lowest cross-entropy per character. A small logistic
model, fitted on training rows that were kept out of the counts, turns the margin
to the second language into a confidence; the cross-entropies of these rows also
give the limit beyond which a text is marked as rejected.

Letters are compared in lower case and everything else is one separator.

Defined results: null texts and texts without a letter are ``und`` with score 0,
as is everything when there is nothing to learn from; ties of languages go to the
first by name; rows without an identifier are scored like others; repeated rows
are scored alike; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from stowage.llm.kernels import mix, texts
from stowage.llm.learn import logistic
from stowage.llm.tables import ID, TEXT, map_texts, scratch, small_batches

ORDER, BITS = 4, 15  # n-grams of four characters with 15 bits each
CALIBRATION_ROWS = 4000
UNKNOWN = "und"
_BLOCK_CHARS = 1 << 19
_MERGE_GRAMS = 1 << 22

_EDGE = 1  # code of the padding between texts
_PAD = "\x01" * (ORDER - 1)


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """Code of each character: 0 for separators, letters by lower case folded to 15 bits."""
    codes = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000 or not (char := chr(c)).isalpha():
            continue
        low = ord(char.lower()[0])
        codes[c] = low if low < 1 << BITS else 2 + low % ((1 << BITS) - 2)
    codes[1] = _EDGE
    return codes


def grams(documents: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The packed n-grams of all characters of some texts, and where each text starts among them."""
    # the padding sign itself counts as a separator inside texts
    joined = _PAD + _PAD.join(d.replace("\x01", " ") for d in documents)
    code = _codes()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
    lengths = np.fromiter(map(len, documents), np.int64, len(documents)) + len(_PAD)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] > 1)  # one separator between words, none at the front
    place = np.concatenate([[0], np.cumsum(keep)])[starts]
    code = code[keep]
    packed = code.copy()
    for back in range(1, ORDER):
        packed[back:] |= code[:-back] << np.uint64(BITS * back)
    inner = code != _EDGE
    return packed[inner], np.concatenate([[0], np.cumsum(inner)])[place]


def _reduced(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-gram counts of a task, by language; memory is bounded by the merge limit."""
    held: dict[str, tuple[list, list]] = {}

    def out(lang: str) -> pa.RecordBatch:
        keys, counts = _reduced(*map(np.concatenate, held.pop(lang)))
        names = pa.array([lang] * len(keys), pa.string())
        return pa.RecordBatch.from_arrays([names, pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"])

    for batch in batches:
        langs, column = batch.column(0).to_pylist(), texts(batch.column(1)).to_pylist()
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(langs, column):
            by_lang.setdefault(lang, []).append(text)
        for lang, documents in by_lang.items():
            for block in _blocks(documents):
                keys, counts = np.unique(grams(block)[0], return_counts=True)
                parts = held.setdefault(lang, ([], []))
                parts[0].append(keys)
                parts[1].append(counts.astype(np.int64))
                if len(parts[0]) >= 16:
                    merged = _reduced(*map(np.concatenate, parts))
                    held[lang] = ([merged[0]], [merged[1]])
                    if len(merged[0]) > _MERGE_GRAMS:
                        yield out(lang)
    for lang in list(held):
        yield out(lang)


def _blocks(documents: list[str]) -> Iterator[list[str]]:
    block, size = [], 0
    for document in documents:
        block.append(document)
        size += len(document)
        if size >= _BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


class Model(NamedTuple):
    langs: list[str]
    keys: list[np.ndarray]  # by order from 1: sorted hashes of n-grams
    logs: list[np.ndarray]  # and their log probabilities, one column per language
    contexts: list[np.ndarray]  # by length from 0: sorted hashes of contexts
    weights: list[np.ndarray]  # and the logs of their back-off weights
    floor: float  # log probability of a character never seen
    limits: list[float]  # cross-entropy per character beyond which a text is rejected
    calibration: list[float]


def _salt(order: int) -> np.uint64:
    return np.uint64(0x5851F42D4C957F2D * order & (1 << 64) - 1)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_keys, keys), max(len(sorted_keys) - 1, 0))
    return at, (sorted_keys[at] == keys) if len(sorted_keys) else np.zeros(len(keys), bool)


def fit(langs: list[str], table: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Interpolated Kneser-Ney models from the counts of the longest n-grams of each language."""
    masks = [np.uint64((1 << BITS * n) - 1) for n in range(ORDER + 1)]
    alphabet = len(np.unique(np.concatenate([t[0] & masks[1] for t in table.values()]))) + 1
    found: list[list] = [[] for _ in range(ORDER + 1)]
    backs: list[list] = [[] for _ in range(ORDER)]
    for lang in langs:
        keys, counts = table[lang]
        levels = {ORDER: (keys, counts)}
        for n in range(ORDER - 1, 0, -1):  # continuation counts: in how many contexts a shorter n-gram ends
            longer = levels[n + 1][0]
            levels[n] = _reduced(longer & masks[n], np.ones(len(longer), np.int64))
        lower = None
        for n in range(1, ORDER + 1):
            keys, counts = levels[n]
            ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
            discount = min(0.95, ones / (ones + 2 * twos)) if ones else 0.1
            context = keys >> np.uint64(BITS)
            first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            total = np.add.reduceat(counts, first)
            kinds = np.diff(np.concatenate([first, [len(keys)]]))
            rest = discount * kinds / total
            group = np.repeat(np.arange(len(first)), kinds)
            if n == 1:
                below = np.full(len(keys), 1 / alphabet)
            else:
                at, _ = _find(levels[n - 1][0], keys & masks[n - 1])
                below = lower[at]
            lower = np.maximum(counts - discount, 0) / total[group] + rest[group] * below
            found[n].append((keys, np.log(lower)))
            backs[n - 1].append((context[first], np.log(rest)))

    def table_of(parts, salt, fill):
        every = np.unique(np.concatenate([k for k, _ in parts]))
        values = np.full((len(every), len(parts)), fill)
        for j, (keys, logs) in enumerate(parts):
            values[np.searchsorted(every, keys), j] = logs
        hashes = mix(every ^ salt)
        order = np.argsort(hashes)
        return hashes[order], values[order]

    floor = -float(np.log(alphabet))
    model = Model(langs, [], [], [], [], floor, [], [])
    for n in range(1, ORDER + 1):
        hashes, logs = table_of(found[n], _salt(n), np.nan)
        model.keys.append(hashes)
        model.logs.append(logs)
        hashes, logs = table_of(backs[n - 1], _salt(-n), 0.0)
        model.contexts.append(hashes)
        model.weights.append(logs)
    return model


def log_probabilities(model: Model, packed: np.ndarray) -> np.ndarray:
    """Log probability of the last character of each n-gram after the others, one column per language."""
    out = np.full((len(packed), len(model.langs)), model.floor)
    for n in range(1, ORDER + 1):  # from single characters up: a longer n-gram seen replaces, else weighs, the shorter
        mask = np.uint64((1 << BITS * n) - 1)
        context = (packed & mask) >> np.uint64(BITS)
        at, there = _find(model.contexts[n - 1], mix(context ^ _salt(-n)))
        out[there] += model.weights[n - 1][at[there]]
        at, there = _find(model.keys[n - 1], mix((packed & mask) ^ _salt(n)))
        seen = model.logs[n - 1][at[there]]
        out[there] = np.where(np.isnan(seen), out[there], seen)
    return out


class _Scorer:
    """Cross-entropies of texts, with a table of the n-grams looked up lately."""

    SLOTS = 1 << 20

    def __init__(self, model: Model):
        self._model = model
        self._keys = np.full(self.SLOTS, np.iinfo(np.uint64).max, np.uint64)
        self._logs = np.zeros((self.SLOTS, len(model.langs)), np.float32)

    def entropies(self, documents: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (one column per language) and scored characters of each text."""
        entropy = np.zeros((len(documents), len(self._model.langs)))
        counts = np.zeros(len(documents), np.int64)
        done = 0
        for block in _blocks(documents):
            packed, starts = grams(block)
            slots = (mix(packed) >> np.uint64(44)).astype(np.int64)
            wrong = np.flatnonzero(self._keys[slots] != packed)
            if len(wrong):
                new, inverse = np.unique(packed[wrong], return_inverse=True)
                logs = log_probabilities(self._model, new).astype(np.float32)
                slot = (mix(new) >> np.uint64(44)).astype(np.int64)
                self._keys[slot], self._logs[slot] = new, logs
            values = self._logs[slots]
            if len(wrong):
                values[wrong] = logs[inverse]
            n = np.diff(starts)
            full = np.flatnonzero(n)
            if len(full):
                sums = np.add.reduceat(values, starts[:-1][full], axis=0, dtype=np.float64)
                entropy[done + full] = -sums / n[full, None]
            counts[done : done + len(block)] = n
            done += len(block)
        return entropy, counts


@lru_cache(maxsize=2)
def _scorer(model: Broadcast) -> _Scorer:
    return _Scorer(model.value)


def _features(best: np.ndarray, second: np.ndarray, n: np.ndarray) -> np.ndarray:
    margin = second - best
    return np.column_stack([np.ones(len(n)), margin, np.log1p(n), np.minimum(margin * np.sqrt(n), 50)])


def _lowest(entropy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pick = entropy.argmin(axis=1)
    rows = np.arange(len(entropy))
    best = entropy[rows, pick]
    if entropy.shape[1] == 1:
        return pick, best, best + 1.0
    rest = entropy.copy()
    rest[rows, pick] = np.inf
    return pick, best, rest.min(axis=1)


def _measured(array: pa.Array, model: Broadcast):
    """Cross-entropies and scored characters of each text, and of a short stretch of it."""
    documents = array.to_pylist()
    # Whole texts are hardly ever mistaken: short stretches of them show what a margin is worth.
    places = [zlib.crc32(d.encode()) for d in documents]
    short = [d[i % 97 : i % 97 + 2 + i % 29] for i, d in zip(places, documents)]
    columns = []
    for some in (documents, short):
        entropy, n = _scorer(model).entropies(some)
        columns += [pa.array(list(entropy), pa.list_(pa.float64())), pa.array(n, pa.int64())]
    return None, columns


def _calibrate(model: Model, langs: list[str], entropy: np.ndarray, n: np.ndarray) -> Model:
    """Confidence and limits from cross-entropies of texts of known languages: whole texts, then as many short ones."""
    pick, best, second = _lowest(entropy)
    known = n > 0
    right = np.array([model.langs[p] == lang for p, lang in zip(pick, langs)], bool)
    whole = known & right & (n >= 20) & (np.arange(len(n)) < len(n) // 2)
    limits = []
    for j in range(len(model.langs)):
        own = best[whole & (pick == j)]
        limits.append(float(np.quantile(own, 0.995)) + 0.4 if len(own) >= 20 else -model.floor)
    if known.sum() < 20:
        return model._replace(limits=limits, calibration=[0.0, 0.0, 0.0, 1.0])
    # Targets short of certainty, by how many rows speak for them.
    hits, misses = (known & right).sum(), (known & ~right).sum()
    target = np.where(right, (hits + 1) / (hits + 2), 1 / (misses + 2))
    weights = logistic(_features(best, second, n)[known], target[known], ridge=1.0)
    return model._replace(limits=limits, calibration=[float(w) for w in weights])


def learn(
    docs: DataFrame,
    training: Column,
    calibration: Column,
    lang_col: str = "lang",
    text_col: str = TEXT,
    calibration_rows: int = CALIBRATION_ROWS,
) -> Model | None:
    """A model from the rows where ``training`` holds; of these, ``calibration`` rows fit the confidence only.

    All training rows are counted and all their n-grams are kept, so that a model grows
    with the n-grams of its languages; ``calibration_rows`` bounds the rows that the
    confidence is fitted on. They are the same share for each language, chosen by a hash of
    the text, and are scored in tasks: only their cross-entropies come to the driver.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(training & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), calibration.alias("aside"))
    counts = (
        rows.where("not aside").select("lang", "text").mapInArrow(_count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    counts = scratch(docs.sparkSession).table(counts, "grams")
    kept = counts.toArrow()
    if not kept.num_rows:
        return None
    names = kept["lang"].combine_chunks().dictionary_encode()
    code, keys, n = names.indices.to_numpy(), kept["gram"].to_numpy().view(np.uint64), kept["n"].to_numpy()
    table = {lang: _reduced(keys[code == j], n[code == j]) for j, lang in enumerate(names.dictionary.to_pylist())}
    langs = sorted(table)
    model = fit(langs, table)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("text"))
    aside = rows.where("aside").where(F.col("lang").isin(langs)).withColumn("place", F.row_number().over(order))
    aside = aside.where(F.col("place") <= max(1, calibration_rows // len(langs)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "entropy array<double>, n bigint, short_entropy array<double>, short_n bigint"
    found = map_texts(aside, partial(_measured, model=shared), schema, "lang", "text").toArrow().to_pylist()
    shared.unpersist()
    # in one order, so that the same rows give the same numbers
    found.sort(key=lambda r: (r[ID], r["n"], r["entropy"], r["short_n"], r["short_entropy"]))
    entropy = np.array([r[c] for c in ("entropy", "short_entropy") for r in found]).reshape(-1, len(langs))
    n = np.array([r[c] for c in ("n", "short_n") for r in found], np.int64)
    return _calibrate(model, [r[ID] for r in found] * 2, entropy, n)


def _predict(array: pa.Array, model: Broadcast):
    documents = array.to_pylist()
    entropy, n = _scorer(model).entropies(documents)
    value = model.value
    pick, best, second = _lowest(entropy)
    letters = np.array([any(map(str.isalpha, d)) for d in documents], bool)
    z = _features(best, second, n) @ np.array(value.calibration)
    score = np.where(letters, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)
    lang = [value.langs[p] if known else UNKNOWN for p, known in zip(pick, letters)]
    rejected = ~letters | (best > np.array(value.limits)[pick])
    return None, [pa.array(lang, pa.string()), pa.array(score), pa.array(np.where(letters, best, 0.0)), pa.array(rejected)]


def identify(docs: DataFrame, model: Model | None, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """lang_pred, score (0 to 1), cross_entropy and rejected of every text.

    ``rejected`` marks texts without a letter and texts that fit none of the
    languages; ``lang_pred`` is the nearest language all the same.
    """
    schema = "lang_pred string, score double, cross_entropy double, rejected boolean"
    if model is None:
        nothing = [F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("cross_entropy")]
        return docs.select(F.col(id_col).alias(ID), *nothing, F.lit(True).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, partial(_predict, model=shared), schema, id_col, text_col)
