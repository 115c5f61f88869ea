"""Statistics, votes and scores of quality and toxicity against plain programs over whole texts."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stowage.llm import quality, toxicity

STOPS, LETTERS = b".,;:?'\"()-", re.compile(rb"[a-z\x80-\xff]+")


def plain_statistics(text):
    raw = (text or "").encode()
    words, lines = re.split(rb"[ \t\r\n]+", raw), re.split(rb"[\r\n]+", raw)
    words, lines = [w for w in words if w], [line for line in lines if line]
    share = lambda wanted: sum(b in wanted for b in raw) / max(len(raw), 1)
    printed = bytes(range(33, 127))
    named = bytes([*range(97, 123), *range(65, 91), *range(48, 58)]) + STOPS + b"!|"
    symbols = bytes(b for b in printed if b not in named)
    most = max(len(words), 1)
    upper = lambda w: sum(65 <= b <= 90 for b in w)
    lower = lambda w: sum(97 <= b <= 122 for b in w)
    return {
        "log_words": math.log1p(len(words)),
        "mean_word": sum(map(len, words)) / most,
        "log_longest_word": math.log1p(max(map(len, words), default=0)),
        "lower_share": share(range(97, 123)),
        "upper_share": share(range(65, 91)),
        "digit_share": share(range(48, 58)),
        "space_share": share(b" \t"),
        "stop_share": share(STOPS),
        "exclaim_share": share(b"!"),
        "pipe_share": share(b"|"),
        "symbol_share": share(symbols),
        "other_share": share([*range(9), 11, 12, *range(14, 32), *range(127, 256)]),
        "caps_words": sum(upper(w) > 1 and not lower(w) for w in words) / most,
        "marked_words": sum(w[-1] in symbols + b"|!" for w in words) / most,
        "repeated_words": sum(a == b for a, b in zip(words, words[1:])) / most,
        "distinct_words": len(set(words)) / most,
        "top_word": max(Counter(words).values(), default=0) / most,
        "log_lines": math.log1p(len(lines)),
        "log_mean_line": math.log1p(len(raw) / max(len(lines), 1)),
        "repeated_lines": 1 - len(set(lines)) / len(lines) if len(lines) > 1 else 0.0,
    }


def test_statistics(documents):
    rows = {r.doc_id: r for r in quality.statistics(documents).collect()}
    for r in documents.collect():
        for name, value in plain_statistics(r.text).items():
            assert rows[r.doc_id][name] == pytest.approx(value, abs=1e-9), (r.doc_id, name)


def test_quality_scores(documents, labels):
    """The score follows from a text's statistics and the rules, one by one."""
    measured = quality.statistics(documents)
    rules = quality.learn(measured, labels, "quality")
    scores = {r.doc_id: r.score for r in quality.score(measured, rules).collect()}
    for r in documents.collect():
        of_text = [plain_statistics(r.text)[name] for name in quality.STATISTICS]
        near = any(abs(of_text[i] - end) < 1e-9 for rule in rules.rules for i, *ends in rule.conditions for end in ends)
        if near:  # on the border of a rule, rounding decides
            continue
        held = [rule.weight for rule in rules.rules if all(low < of_text[i] <= high for i, low, high in rule.conditions)]
        assert scores[r.doc_id] == pytest.approx(1 / (1 + math.exp(-(rules.intercept + sum(held)))), abs=1e-9)


def beginnings(word):
    return [word[:n] for n in toxicity._PREFIXES if len(word) > n]


def plain_votes(text, learned):
    """``learned``: (sign, is a beginning) -> voter, the first six after the lists."""
    words = LETTERS.findall((text or "").lower().encode())
    written = {w.encode(): voter for voter, listed in toxicity.LISTS.items() for w in listed.split()}
    counts, flagged = Counter(), []
    for word in words:
        voters = [written[word]] if word in written else []
        voters += [learned[word, False]] if (word, False) in learned else []
        voters += [learned[part, True] for part in beginnings(word) if (part, True) in learned]
        counts.update(voters)
        flagged.append(bool(voters))
    address = {w.encode() for w in toxicity._ADDRESS.split()}
    counts["addressed"] = sum(
        flagged[i + step] for i, w in enumerate(words) if w in address for step in (1, 2, 3) if i + step < len(words)
    )
    counts["several"] = max(len({w for w, f in zip(words, flagged) if f}) - 1, 0)
    hits = sum(flagged)
    counts["dense"] = hits if hits * 100 > max(len(words), 50) else 0
    return {**{v: counts[v] for v in toxicity.VOTERS}, "n_words": len(words)}


def signs_of(texts, signs):
    """The learned signs by their bytes: those words and beginnings of the texts whose hash is among them."""
    voter = dict(zip(signs.hashes.tolist(), signs.voters.tolist()))
    known = {}
    for text in texts:
        for word in set(LETTERS.findall((text or "").lower().encode())):
            for raw, size in [(word, 0), *[(part, len(part)) for part in beginnings(word)]]:
                if (found := voter.get(raw_code(raw) ^ size)) is not None:
                    known[raw, size > 0] = toxicity.VOTERS[found]
    return known


def raw_code(raw):
    return int(toxicity.Rolling(np.frombuffer(raw, np.uint8)).of(np.array([0]), np.array([len(raw)]))[0])


def test_votes_and_scores(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    labelled = toxicity.labelled_texts(documents, labels, "toxic")
    signs = toxicity.choose(labelled)
    voted = toxicity.votes(documents, signs)
    classifier = toxicity.learn(voted, labelled, signs)
    rows = {r.doc_id: r for r in voted.withColumn("score", classifier.score()).collect()}
    texts = documents.collect()
    learned = signs_of([r.text for r in texts], signs)
    assert len(signs.hashes) and learned
    for r in texts:
        want = plain_votes(r.text, learned)
        got = rows[r.doc_id]
        assert {v: got[v] for v in want} == want, r.doc_id
        z = classifier.weights[0]
        for i, voter in enumerate(toxicity.VOTERS):
            z += classifier.weights[1 + 2 * i] * math.log1p(want[voter]) + classifier.weights[2 + 2 * i] * (want[voter] > 0)
        assert got.score == pytest.approx(1 / (1 + math.exp(-(classifier.slope * z + classifier.shift))), abs=1e-9)


def test_labels_of_one_identifier_do_not_gather(spark, documents):
    """A sample drawn by a hash of identifiers stays bounded where one identifier has most rows."""
    from stowage.llm.learn import bounded_sample

    rows = documents.select(F.lit(7).alias("doc_id")).unionByName(spark.range(5000).select(F.lit(7).cast("int").alias("doc_id")))
    assert bounded_sample(rows, 100, rows.count(), "doc_id").count() <= 200
