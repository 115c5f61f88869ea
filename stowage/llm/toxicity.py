"""Toxicity by weak supervision: many voters, a label model, a linear classifier.

Voters are word lists written by hand, words and word beginnings that labelled rows
show to be signs, and patterns (direct address, several signs, dense signs). A
generative model gives each voter a rate of firing on toxic and on clean texts and
discounts voters by their correlations; expectation-maximisation fits it to the
counts of vote patterns over all documents, with labelled rows as anchors. Its
posteriors train a linear classifier over the voters' counts, whose score is
calibrated on labelled rows. The classifier is a Spark column expression.

Defined results: null and empty texts have no votes and the score of texts without
votes; without labels only the lists and patterns vote; repeated rows get equal
scores; labels other than 0 and 1 don't count; empty tables give no rows; other
columns are not read.
"""

from __future__ import annotations

from functools import partial, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from stowage.llm.kernels import Rolling, blocks, runs, shingles
from stowage.llm.learn import bounded_sample, logistic
from stowage.llm.tables import ID, TEXT, map_texts, scratch

LABEL_ROWS = 20_000  # labelled rows that voters are chosen and calibrated on, at most
POSTERIOR_ROWS = 20_000  # rows that the linear classifier is trained on, at most
SIGNS = 20_000  # words and beginnings that are tried, the most frequent in toxic rows first
LEAST_ROWS = 6

# Word lists by theme, in four languages.
LISTS = {
    "insult": "idiot moron loser clown fool dumbass imbecile cretin dummkopf trottel idioten imbécile abruti crétin idiota "
    "imbécil estúpido tonto",
    "contempt": "stupid pathetic worthless disgusting useless ridiculous vile erbärmlich wertlos ekelhaft dumm nutzlos "
    "stupide minable dégoûtant inutile patético asqueroso",
    "degradation": "trash scum garbage vermin filth parasite subhuman abschaum ungeziefer müll ordure vermine racaille "
    "escoria basura alimaña",
    "threat": "kill hurt destroy punch strangle umbringen verrecken schlagen tuer crève frapper matar muere golpear",
    "profanity": "damn crap bastard bitch asshole shit fuck verdammt scheiße arschloch merde connard salaud mierda cabrón "
    "puta",
    "hate": "hate despise loathe detest hasse verachte déteste méprise odio detesto desprecio",
}
_ADDRESS = "you your youre du dich dein ihr euch tu toi vous ton eres usted ustedes tú"
_PREFIXES = (4, 5, 6, 7, 8)  # bytes of a word's beginning
VOTERS = (
    *LISTS, "strong_word", "middle_word", "weak_word", "strong_start", "middle_start", "weak_start",
    "addressed", "several", "dense",
)
_COUNTED = len(LISTS) + 6

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


class Signs(NamedTuple):
    """Hashes of signs, sorted, with the voter of each."""

    hashes: np.ndarray
    voters: np.ndarray

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the signs among some codes, and their voters."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sieve = np.zeros(1 << 20, bool)
        sieve[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        at = np.flatnonzero(sieve[(codes >> np.uint64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.hashes, codes[at]), len(self.hashes) - 1)
        right = self.hashes[place] == codes[at]
        return at[right], self.voters[place[right]]


def _codes(data: np.ndarray, offsets: np.ndarray):
    """Hashes of all words and, by length, of the beginnings of the longer ones, with the word each belongs to."""
    starts, ends, bounds = runs(_LETTER[data], offsets)
    rolling = Rolling(data)
    whole = rolling.of(starts, ends)
    parts = [(np.arange(len(starts)), whole)]
    for size in _PREFIXES:
        longer = np.flatnonzero(ends - starts > size)
        parts.append((longer, rolling.of(starts[longer], starts[longer] + size) ^ np.uint64(size)))
    return whole, bounds, parts


def _hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw])
    return Rolling(np.frombuffer(b"".join(raw), np.uint8)).of(ends - [len(r) for r in raw], ends)


def _written() -> Signs:
    hashes = np.concatenate([_hashes(words.split()) for words in LISTS.values()])
    voters = np.repeat(np.arange(len(LISTS)), [len(words.split()) for words in LISTS.values()])
    hashes, first = np.unique(hashes, return_index=True)
    return Signs(hashes, voters[first])


def _sketch(array: pa.Array):
    """A number that near copies mostly share: the least hash of their five-word runs."""
    out = []
    for _, _, data, offsets in blocks(pc.utf8_lower(array)):
        whole, bounds, _ = _codes(data, offsets)
        out += [int(s[0]) if len(s) else 0 for s in shingles(whole, bounds, 5)]
    return None, [pa.array(np.array(out, np.uint64).view(np.int64))]


def _present(array: pa.Array, among: np.ndarray | None):
    """Signs in a batch of texts with the number of texts that have them; only those in ``among``, if given."""
    found = []
    for _, _, data, offsets in blocks(pc.utf8_lower(array)):
        _, bounds, parts = _codes(data, offsets)
        word, code = (np.concatenate(c) for c in zip(*parts))
        if among is not None:
            at, _ = Signs(among, np.zeros(len(among), np.int64)).find(code)
            word, code = word[at], code[at]
        doc = np.searchsorted(bounds, word, "right") - 1
        order = np.lexsort((doc, code))
        doc, code = doc[order], code[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
        found.append(code[new])
    codes, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
    # any row of the batch will do: only sums over rows are used
    return np.zeros(len(codes), np.int64), [pa.array(codes.view(np.int64)), pa.array(counts)]


def _votes(array: pa.Array, written: Signs, learned: Signs):
    address = np.sort(_hashes(_ADDRESS.split()))
    out = []
    for _, _, data, offsets in blocks(pc.utf8_lower(array)):
        documents = len(offsets) - 1
        whole, bounds, parts = _codes(data, offsets)
        counts = np.zeros((documents, _COUNTED), np.int64)
        flagged = np.zeros(len(whole) + 3, bool)
        distinct: list[np.ndarray] = []
        for word, code in parts:
            for signs in (written, learned) if word is parts[0][0] else (learned,):
                at, voter = signs.find(code)
                doc = np.searchsorted(bounds, word[at], "right") - 1
                np.add.at(counts, (doc, voter), 1)
                flagged[word[at]] = True
                if signs is learned:
                    distinct.append(word[at])
        flagged = flagged[: len(whole)]
        owner = np.repeat(np.arange(documents), np.diff(bounds))
        hits = np.bincount(owner[flagged], minlength=documents)
        calls, _ = Signs(address, np.zeros(len(address), np.int64)).find(whole)
        addressed = np.zeros(documents, np.int64)
        for step in (1, 2, 3):
            near = calls[calls + step < len(whole)]
            near = near[flagged[near + step] & (owner[near + step] == owner[near])]
            addressed += np.bincount(owner[near], minlength=documents)
        # different flagged words of a text
        pairs = np.unique(np.column_stack([owner[flagged].astype(np.uint64), whole[flagged]]), axis=0)
        kinds = np.bincount(pairs[:, 0].astype(np.int64), minlength=documents)
        n = np.diff(bounds)
        patterns = [addressed, np.maximum(kinds - 1, 0), hits * (hits * 100 > np.maximum(n, 50))]
        out.append(np.column_stack([counts, *patterns, n]))
    table = np.concatenate(out) if out else np.zeros((0, len(VOTERS) + 1), np.int64)
    return None, [pa.array(column) for column in table.T.astype(np.int64)]


def choose(labelled: DataFrame, signs: int = SIGNS) -> Signs:
    """Words and beginnings that are far more frequent in toxic rows, in six voters by kind and strength.

    ``labelled`` has the columns label and text.
    """
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    empty = Signs(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    if not toxic or not clean:
        return empty

    def counted(label: int, among: np.ndarray | None) -> DataFrame:
        rows = labelled.where(F.col("label") == label)
        kernel = partial(_present, among=among)
        found = map_texts(rows, kernel, "sign bigint, n bigint", "label", "text")
        return found.groupBy("sign").agg(F.sum("n").alias("n"))

    often = counted(1, None).where(F.col("n") >= LEAST_ROWS).orderBy(F.desc("n"), "sign").limit(signs).toArrow()
    order = np.argsort(often["sign"].to_numpy().view(np.uint64))
    codes, in_toxic = often["sign"].to_numpy().view(np.uint64)[order], often["n"].to_numpy()[order]
    if not len(codes):
        return empty
    rare = counted(0, codes).toArrow()
    in_clean = np.zeros(len(codes), np.int64)
    in_clean[np.searchsorted(codes, rare["sign"].to_numpy().view(np.uint64))] = rare["n"].to_numpy()
    odds = np.log((in_toxic + 0.5) / (toxic + 1)) - np.log((in_clean + 0.5) / (clean + 1))
    kept = (odds > 1.5) & (in_toxic * odds > 20)
    strength = np.where(odds > 4, 0, np.where(odds > 2.5, 1, 2))
    starts = _is_start(labelled, codes[kept])
    voters = len(LISTS) + strength[kept] + 3 * starts
    return Signs(codes[kept], voters.astype(np.int64))


def _kinds(array: pa.Array, among: np.ndarray):
    found = []
    for _, _, data, offsets in blocks(pc.utf8_lower(array)):
        whole = _codes(data, offsets)[0]
        found.append(np.intersect1d(whole, among))
    codes = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
    return np.zeros(len(codes), np.int64), [pa.array(codes.view(np.int64))]


def _is_start(labelled: DataFrame, codes: np.ndarray) -> np.ndarray:
    """Which of the signs are beginnings only, and never a whole word of a toxic row."""
    rows = labelled.where(F.col("label") == 1)
    whole = map_texts(rows, partial(_kinds, among=codes), "sign bigint", "label", "text").select("sign").distinct()
    words = whole.toArrow()["sign"].to_numpy().view(np.uint64)
    return (~np.isin(codes, words)).astype(np.int64)


class LabelModel(NamedTuple):
    prior: float
    rates: np.ndarray  # of firing: row 0 on clean, row 1 on toxic texts
    shares: np.ndarray  # of a voter's evidence that its correlations leave

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        evidence = np.where(fired, np.log(self.rates[1] / self.rates[0]), np.log((1 - self.rates[1]) / (1 - self.rates[0])))
        z = np.log(self.prior / (1 - self.prior)) + evidence @ self.shares
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def label_model(
    fired: np.ndarray, mass: np.ndarray, anchors: np.ndarray, labels: np.ndarray, anchor_mass: np.ndarray, rounds: int = 25
) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns with their masses; anchors are patterns of known label."""
    voters = fired.shape[1]
    every, weight = np.concatenate([fired, anchors]).astype(float), np.concatenate([mass, anchor_mass]).astype(float)
    given = np.concatenate([np.full(len(fired), np.nan), labels])
    prior = min(max(float((labels * anchor_mass).sum() / max(anchor_mass.sum(), 1e-9)), 0.01), 0.5) if len(labels) else 0.1
    if not len(every):
        return LabelModel(prior, np.full((2, voters), 0.5), np.ones(voters))
    # To begin with: any vote is a sign.
    p = np.where(np.isnan(given), np.clip(0.6 * every.any(axis=1), 0.01, None), given)
    shares = np.ones(voters)
    for _ in range(rounds):
        rates = np.empty((2, voters))
        for kind, own in ((0, 1 - p), (1, p)):
            own = own * weight
            rates[kind] = (own @ every + 1e-4 * own.sum() + 0.01) / (own.sum() * (1 + 2e-4) + 0.02)
        rates[1] = np.maximum(rates[1], rates[0])  # a vote never speaks for a clean text
        together = np.zeros((voters, voters))
        for kind, own in ((0, 1 - p), (1, p)):
            off = every - rates[kind]
            scale = np.sqrt(rates[kind] * (1 - rates[kind]) * max((own * weight).sum(), 1e-9))
            together += ((off * (own * weight)[:, None]).T @ off) / np.outer(scale, scale) / 2
        shares = 1 / np.maximum(1, np.clip(together, 0, 1).sum(axis=1))
        model = LabelModel(prior, np.clip(rates, 1e-6, 1 - 1e-6), shares)
        new = np.where(np.isnan(given), model.posterior(every > 0), given)
        if np.abs(new - p).max() < 1e-5:
            break
        p = new
    return model


class Classifier(NamedTuple):
    weights: np.ndarray  # intercept, then for each voter of its counts and of its firing
    slope: float
    shift: float

    def score(self) -> Column:
        z = F.lit(float(self.weights[0]))
        for i, voter in enumerate(VOTERS):
            z = z + float(self.weights[1 + 2 * i]) * F.log1p(voter)
            z = z + F.when(F.col(voter) > 0, float(self.weights[2 + 2 * i])).otherwise(0.0)
        return 1 / (1 + F.exp(-(self.slope * z + self.shift)))


def _inputs(counts: np.ndarray) -> np.ndarray:
    parts = [np.ones(len(counts))]
    for column in counts.T:
        parts += [np.log1p(column), column > 0]
    return np.column_stack(parts).astype(float)


def votes(docs: DataFrame, signs: Signs, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """How often each voter fires on each text, and its words."""
    schema = ", ".join(f"{v} bigint" for v in (*VOTERS, "n_words"))
    return map_texts(docs, partial(_votes, written=_written(), learned=signs), schema, id_col, text_col)


def labelled_texts(docs: DataFrame, labels: DataFrame, label_col: str, rows: int = LABEL_ROWS) -> DataFrame:
    """label and text of labelled rows, at most about ``rows``, one of each group of near copies in most cases."""
    own = labels.select(F.col(ID), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    own = bounded_sample(own, rows, own.count(), ID)
    # at most about `rows` rows of two numbers
    found = docs.select(ID, TEXT).where(F.col(TEXT).isNotNull()).join(F.broadcast(own), ID).select("label", TEXT)
    found = scratch(docs.sparkSession).table(found, "labelled")
    sketched = map_texts(found.withColumn("pair", F.struct("label", TEXT)), _sketch, "sketch bigint", "pair", TEXT)
    return sketched.groupBy(F.col("doc_id.label").alias("label"), "sketch").agg(F.first("doc_id.text").alias(TEXT)).drop("sketch")


def learn(voted: DataFrame, labelled: DataFrame, signs: Signs, rows: int = POSTERIOR_ROWS) -> Classifier:
    """A classifier from the votes on all documents (``voted``) and labelled texts."""
    fired = [(F.col(v) > 0).cast("int").alias(v) for v in VOTERS]
    patterns = voted.groupBy(*fired).count().toArrow()  # at most 2 to the number of voters rows
    table = np.column_stack([patterns[v].to_numpy() for v in VOTERS]).reshape(-1, len(VOTERS)) > 0
    anchors = votes(labelled, signs, "label", TEXT).toArrow()
    known = anchors["doc_id"].to_numpy().astype(float)
    anchor_counts = np.column_stack([anchors[v].to_numpy() for v in VOTERS]).reshape(-1, len(VOTERS))
    model = label_model(table, patterns["count"].to_numpy(), anchor_counts > 0, known, np.full(len(known), 5.0))

    sample = bounded_sample(voted, rows, voted.count(), ID, "n_words").select(*VOTERS).toArrow()
    counts = np.column_stack([sample[v].to_numpy() for v in VOTERS]).reshape(-1, len(VOTERS))
    x, y = _inputs(np.concatenate([counts, anchor_counts])), model.posterior(np.concatenate([counts, anchor_counts]) > 0)
    weights = logistic(x, y, ridge=1.0) if len(x) else np.zeros(1 + 2 * len(VOTERS))
    slope, shift = 1.0, 0.0
    if len(set(known.tolist())) == 2:
        z = _inputs(anchor_counts) @ weights
        shift, slope = logistic(np.column_stack([np.ones(len(z)), z]), known, ridge=1e-3).tolist()
    return Classifier(weights, slope, shift)
