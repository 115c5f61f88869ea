"""Personal data by weak supervision, on DataFrame functions alone.

Four base kinds follow fixed patterns with checks on their matches. Further spans
(secrets, identity numbers, bank accounts, dates of birth, user names, persons) come
from wide patterns whose matches are only candidates: labelers look at their shape,
at word lists and at the text around them, and vote for, against or not at all.
Expectation-maximisation over the counts of vote patterns (a bounded number of rows)
estimates how reliable each labeler is; the posteriors train a logistic classifier over
features of the candidate, which decides as a column expression.

Java's regular expressions run on whole texts, so patterns are written without
nested backtracking: runs are possessive, and a match starts where a run starts.
Positions come from the lengths of the pieces between matches, in code points.

Defined results: null and empty texts have no spans; rows with equal or without
identifiers are judged alone; matches of different kinds may overlap, matches of one
kind never do; empty tables give no rows; other columns are kept by ``redact`` and not
read otherwise.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from stowage.llm.learn import logistic
from stowage.llm.tables import ID, TEXT

# The base kinds in their order.
BASE_KINDS = ("email", "ip", "card", "phone")
FOUND_KINDS = ("secret", "identity", "account", "birth", "handle", "person")
KINDS = (*BASE_KINDS, *FOUND_KINDS)

# A run starts at the front, after the match before, or after another character.
_LOCAL = "[A-Za-z0-9._%+-]"
_BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_CANDIDATES = {
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]{0,128}+[0-9])[A-Za-z0-9_/+-]{16,256}+(?![A-Za-z0-9_/+-])",
    "identity": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "account": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "birth": r"(?<![0-9./-])(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4})(?![0-9])",
    "handle": r"(?<![A-Za-z0-9._%+@-])@[A-Za-z][A-Za-z0-9_]{2,29}+(?![A-Za-z0-9_.@-])",
    "person": r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Madame|Señor|Señora)\.?\x20\p{Lu}\p{L}{1,30}+(?:\x20\p{Lu}\p{L}{1,30}+)?",
}
# What a text must hold for a pattern to be tried at all.
_NEEDS = {
    "email": "@", "handle": "@", "phone": "+",
}

_GIVEN_NAMES = "james|john|mary|anna|peter|maria|jose|juan|hans|klaus|pierre|jean|marie|carlos|ana|sarah|david|michael"
_CUES = {
    "secret": "token|secret|passw(?:or)?d|api.?key|access.?key|auth|bearer|credential|private.?key",
    "identity": "ssn|social.?security|sozialversicherung|passport|pass(?:nummer|eport)|identity|dni|id.?n(?:o|umber)",
    "account": "iban|account|konto|bank|compte|cuenta|bic",
    "birth": "born|birth|dob|geboren|geburt|né[e]? le|naissance|nacid[oa]|nacimiento",
    "handle": "twitter|instagram|user(?:name)?|handle|follow|contact|telegram|dm",
    "person": "name|contact|dear|sincerely|signed|patient|client|kunde|nom|nombre|von|from|by",
}
_AROUND = 40  # code points of context before a candidate


def _matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern as an array of (start, end, text), leftmost and without overlap."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,hit:string>>").alias("found"))

    def step(done: Column, pair: Column) -> Column:
        first = done["at"] + F.length(pair["between"])
        last = first + F.length(pair["hit"])
        span = F.struct(first.cast("int").alias("start"), last.cast("int").alias("end"), pair["hit"].alias("hit"))
        return F.struct(last.cast("int").alias("at"), F.concat(done["found"], F.array(span)).alias("found"))

    pairs = F.zip_with(hits, F.slice(between, F.lit(1), F.size(hits)), lambda h, b: F.struct(h.alias("hit"), b.alias("between")))
    return F.aggregate(pairs, start, step, lambda done: done["found"])


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(place: Column) -> Column:  # places from the right, the first is 0
        digit = F.substr(digits, n - place, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(place % 2 == 0, digit).when(double > 9, double - 9).otherwise(double)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda total, place: total + value(place)) % 10 == 0


def _holds(kind: str, hit: Column) -> Column:
    """The check on a match of a base kind."""
    if kind == "ip":
        least = lambda part: F.regexp_replace(part, r"^0+(?=[0-9])", "")
        return F.forall(F.split(hit, r"\."), lambda p: (F.length(least(p)) <= 3) & (F.substr(least(p), F.lit(1), F.lit(3)).cast("int") <= 255))
    if kind == "card":
        n = F.length(_digits(hit))
        return F.when((n >= 12) & (n <= 19), _luhn(_digits(hit))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _none(kind: str) -> Column:
    return F.array().cast(kind)


_SPAN = "array<struct<start:int,end:int,hit:string>>"


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Matches of a pattern, with everything costly left out for texts that can't match."""
    needs = F.contains(text, F.lit(_NEEDS[kind])) if kind in _NEEDS else F.col("_digit") if kind != "person" else F.lit(True)
    return F.when(needs & text.rlike(pattern), _matches(text, pattern)).otherwise(_none(_SPAN))


def find(docs: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """doc_id, text, base spans and candidates, each an array sorted by start and kind.

    A base span has start, rank (of its kind) and end; a candidate also its features.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias(ID), text.alias("_text")).withColumn("_digit", F.col("_text").rlike("[0-9]"))
    text = F.col("_text")
    rows = rows.withColumns({f"_{k}": _found(text, k, p) for k, p in {**_BASE, **_CANDIDATES}.items()})

    def checked(kind: str) -> Column:
        rank = F.lit(KINDS.index(kind)).alias("rank")
        kept = F.filter(f"_{kind}", lambda s: _holds(kind, s["hit"]))
        return F.transform(kept, lambda s: F.struct(s["start"], rank, s["end"]))

    base = F.array_sort(F.concat(*map(checked, BASE_KINDS)))
    rows = rows.withColumn("base", base)

    def described(kind: str) -> Column:
        # what a base span covers is no candidate
        free = F.filter(f"_{kind}", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        return F.transform(free, lambda s: _described(kind, s, text))

    rows = rows.withColumn("candidates", F.concat(*map(described, FOUND_KINDS)))
    return rows.select(ID, text.alias(TEXT), "base", "candidates")


LABELERS = ("cue", "shape", "gazetteer", "assigned", "prose", "plain")


def _described(kind: str, span: Column, text: Column) -> Column:
    """A candidate with the votes of the labelers: 1 for, 0 against, -1 abstains."""
    hit, start = span["hit"], span["start"]
    first = F.greatest(start - _AROUND, F.lit(0))
    before = F.substr(text, first + 1, start - first)
    digits = F.length(_digits(hit))
    letters = F.length(F.regexp_replace(hit, "[^A-Za-z]", ""))
    cue = before.rlike(rf"(?i)(?<![\p{{L}}])(?:{_CUES[kind]})s?[\"']?(?:\x20(?:is|ist|est|es|no|nr))?[^\p{{L}}0-9]{{0,6}}$")
    votes = {
        "cue": F.when(cue, 1).otherwise(-1),
        "shape": {
            "secret": F.when((digits >= 4) & (letters >= 3) & (digits + letters >= 0.8 * F.length(hit)), 1).otherwise(0),
            "identity": F.when(hit.rlike("^(?:000|666|9[0-9]{2})"), 0).otherwise(1),
            "account": F.when(digits >= 10, 1).otherwise(0),
            "birth": F.when(hit.rlike("(?:19[0-9]{2}|20[01][0-9])"), -1).otherwise(0),
            "handle": F.when(digits > 0, 1).otherwise(-1),
            "person": F.when(hit.rlike(r"\p{Lu}\p{Ll}+$"), 1).otherwise(0),
        }[kind],
        "gazetteer": F.when(hit.rlike(rf"(?i)(?:{_GIVEN_NAMES})"), 1).otherwise(-1),
        "assigned": F.when(before.rlike("[=:]\\s{0,3}[\"']?$"), 1).otherwise(-1),
        "prose": F.when(before.rlike(r"\p{L}[\p{L}\x20,.]{12,}$") & ~cue, 0).otherwise(-1),
        "plain": F.when((letters == 0) & (digits < 9) & ~cue, 0).when((digits == 0) & ~cue, 0).otherwise(-1),
    }
    rank = F.lit(KINDS.index(kind)).alias("rank")
    return F.struct(
        start, rank, span["end"], *[votes[v].cast("int").alias(v) for v in LABELERS],
        F.when(F.length(hit) >= 24, 1).otherwise(0).alias("long"),
    )


class SpanModel(NamedTuple):
    """Weights of the classifier: for each kind, for each labeler voting for and against, and for length."""

    kinds: dict[int, float]
    votes: dict[tuple[str, int], float]
    long: float
    accuracies: dict[str, float]

    def keeps(self, candidate: Column) -> Column:
        z = reduce(lambda rest, k: F.when(candidate["rank"] == k, self.kinds[k]).otherwise(rest), self.kinds, F.lit(-10.0))
        for (labeler, vote), weight in self.votes.items():
            z = z + F.when(candidate[labeler] == vote, weight).otherwise(0.0)
        return z + candidate["long"] * self.long > 0


def reliabilities(votes: np.ndarray, mass: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each vote pattern, and how often each labeler that votes is right."""
    count = votes.shape[1]
    right, prior = np.full(count, 0.8), 0.3
    p = np.full(len(votes), prior)
    for _ in range(rounds):
        z = np.full(len(votes), np.log(prior / (1 - prior)))
        gain = np.log(right / (1 - right))
        z += np.where(votes == 1, gain, np.where(votes == 0, -gain, 0)).sum(axis=1)
        new = 1 / (1 + np.exp(-z))
        agree = np.where(votes == 1, new[:, None], np.where(votes == 0, 1 - new[:, None], 0))
        voted = (votes >= 0) * mass[:, None]
        # a beta prior keeps labelers better than chance and never certain
        right = np.clip(((agree * mass[:, None]).sum(axis=0) + 8) / (voted.sum(axis=0) + 10), 0.55, 0.98)
        prior = float(np.clip((new * mass).sum() + 3, 1e-9, None) / (mass.sum() + 10))
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return p, right


def fit(found: DataFrame) -> SpanModel:
    """Estimate the labelers from all candidates of ``find`` and train the classifier on their posteriors."""
    features = ["rank", *LABELERS, "long"]
    # at most as many rows as there are feature patterns: six kinds, six labelers of two or three votes, one flag
    rows = found.select(F.explode("candidates").alias("c")).groupBy(*[F.col(f"c.{f}").alias(f) for f in features]).count().collect()
    kinds = [KINDS.index(k) for k in FOUND_KINDS]
    pairs = [(labeler, vote) for labeler in LABELERS for vote in (0, 1)]
    if not rows:
        return SpanModel(dict.fromkeys(kinds, -10.0), dict.fromkeys(pairs, 0.0), 0.0, dict.fromkeys(LABELERS, 0.5))
    votes = np.array([[r[v] for v in LABELERS] for r in rows])
    mass = np.array([r["count"] for r in rows], float)
    posterior, right = reliabilities(votes, mass)
    x = np.array(
        [[1.0, *[r["rank"] == k for k in kinds], *[r[v] == vote for v, vote in pairs], r["long"]] for r in rows], float
    )
    # Many candidates alike say no more than a few thousand.
    w = logistic(x, posterior, weights=mass / max(1.0, mass.sum() / 1000), ridge=0.05)
    weights = {k: float(w[0] + w[1 + i]) for i, k in enumerate(kinds)}
    of_votes = {pair: float(w[1 + len(kinds) + i]) for i, pair in enumerate(pairs)}
    return SpanModel(weights, of_votes, float(w[-1]), dict(zip(LABELERS, right.tolist())))


def spans(found: DataFrame, model: SpanModel) -> DataFrame:
    """``found`` with ``spans``: base spans and the candidates that the model keeps, by start and kind."""
    kept = F.transform(F.filter("candidates", model.keeps), lambda c: F.struct(c["start"], c["rank"], c["end"]))
    return found.withColumn("spans", F.array_sort(F.concat("base", kept)))


def written(column: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", names[s["rank"]], s["start"], s["end"])
    return F.array_join(F.transform(column, one), ",")


def of_kind(column: str, kind: str) -> Column:
    return F.size(F.filter(column, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def redact(docs: DataFrame, model: SpanModel, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in angle brackets; overlapping spans become one."""
    # everything a row has travels along, under names that can't clash with those used here
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = whole.withColumn("body", F.col("row").getField(text_col))
    found = spans(find(whole, "row", "body"), model)
    names = F.array(*map(F.lit, KINDS))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substr(F.col(TEXT), done["at"] + 1, span["start"] - done["at"])
        fresh = F.array(gap, F.concat(F.lit("<"), names[span["rank"]], F.lit(">")))
        parts = F.when(span["start"] >= done["at"], F.concat(done["parts"], fresh)).otherwise(done["parts"])
        return F.struct(F.greatest(done["at"], span["end"]).cast("int").alias("at"), parts.alias("parts"))

    def joined(done: Column) -> Column:
        rest = F.substr(F.col(TEXT), done["at"] + 1, F.greatest(F.length(TEXT) - done["at"], F.lit(0)))
        return F.concat(F.array_join(done["parts"], ""), rest)

    clean = F.when(F.size("spans") == 0, F.col(f"{ID}.{text_col}")).otherwise(F.aggregate("spans", begin, step, joined))
    found = found.withColumn("_clean", clean)
    return found.select(*[F.col("_clean").alias(c) if c == text_col else F.col(f"{ID}.`{c}`") for c in docs.columns])
