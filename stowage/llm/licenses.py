"""License detection by ordered signature rules.

Each rule is a regular expression with a label, a priority and a keyword without
which it can't match. Texts are cut into words once; the hashes of the words find
the fixed phrases and tell which rules to try. Detections that lie within one of
higher priority (or of the same priority and longer) are suppressed; the rest
give the labels and the score.

Defined results: null and empty texts have no words, empty labels and score 0; each
row is judged alone, so that repeated rows, ties of identifiers and other columns
make no difference; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stowage.llm.kernels import Rolling, blocks, runs
from stowage.llm.tables import ID, TEXT, map_texts

# The phrases of the contract and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_WORD = np.ones(256, bool)
_WORD[0x00:0x30] = _WORD[0x3A:0x61] = _WORD[0x7B:0x80] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Rule(NamedTuple):
    label: str
    keyword: str  # a word of every text that the pattern matches
    pattern: str  # over the text with A-Z in lower case
    priority: int
    weight: float


_GAP = r"[\x00-/:-`{-\x7f]{1,12}"  # what separates words
_VERSION = rf"(?:,?{_GAP}?(?:version|v\.?|ver\.?)?{_GAP}?(\d(?:\.\d)*))?"

# label: (keyword, ways to write the name)
_FAMILIES = {
    "gpl": ("gnu", ["gnu general public licen[sc]e", "gnu gpl"]),
    "gpl-short": ("gpl", ["gpl", "gplv2", "gplv3"]),
    "lgpl": ("lesser", ["gnu lesser general public licen[sc]e", "lesser general public licen[sc]e"]),
    "lgpl-library": ("library", ["gnu library general public licen[sc]e"]),
    "lgpl-short": ("lgpl", ["gnu lgpl", "lgpl"]),
    "agpl": ("affero", ["gnu affero general public licen[sc]e", "affero general public licen[sc]e"]),
    "agpl-short": ("agpl", ["gnu agpl", "agpl"]),
    "gfdl": ("documentation", ["gnu free documentation licen[sc]e"]),
    "apache": ("apache", ["apache licen[sc]e", "apache software licen[sc]e", "apache public licen[sc]e"]),
    "mit": ("mit", ["mit licen[sc]e", "mit x11 licen[sc]e", "mit expat licen[sc]e"]),
    "x11": ("x11", ["x11 licen[sc]e"]),
    "expat": ("expat", ["expat licen[sc]e"]),
    "bsd": ("bsd", ["bsd licen[sc]e", "bsd style licen[sc]e", "berkeley bsd licen[sc]e"]),
    "bsd-2-clause": ("clause", ["2 clause bsd", "bsd 2 clause", "two clause bsd", "simplified bsd 2 clause"]),
    "bsd-3-clause": ("clause", ["3 clause bsd", "bsd 3 clause", "three clause bsd", "modified bsd 3 clause"]),
    "bsd-4-clause": ("clause", ["4 clause bsd", "bsd 4 clause", "four clause bsd"]),
    "mpl": ("mozilla", ["mozilla public licen[sc]e"]),
    "epl": ("eclipse", ["eclipse public licen[sc]e"]),
    "edl": ("eclipse", ["eclipse distribution licen[sc]e"]),
    "cddl": ("distribution", ["common development and distribution licen[sc]e"]),
    "cpl": ("common", ["common public licen[sc]e"]),
    "eupl": ("european", ["european union public licen[sc]e"]),
    "isc": ("isc", ["isc licen[sc]e"]),
    "zlib": ("zlib", ["zlib licen[sc]e", "zlib libpng licen[sc]e"]),
    "boost": ("boost", ["boost software licen[sc]e"]),
    "artistic": ("artistic", ["artistic licen[sc]e"]),
    "unlicense": ("unlicense", ["the unlicense", "unlicense"]),
    "wtfpl": ("wtfpl", ["wtfpl"]),
    "python": ("python", ["python software foundation licen[sc]e", "python licen[sc]e"]),
    "php": ("php", ["php licen[sc]e"]),
    "ruby": ("ruby", ["ruby licen[sc]e"]),
    "postgresql": ("postgresql", ["postgresql licen[sc]e"]),
    "openssl": ("openssl", ["openssl licen[sc]e"]),
    "ofl": ("font", ["sil open font licen[sc]e", "open font licen[sc]e"]),
    "odbl": ("database", ["open database licen[sc]e"]),
    "ms-pl": ("microsoft", ["microsoft public licen[sc]e"]),
    "ms-rl": ("microsoft", ["microsoft reciprocal licen[sc]e"]),
    "osl": ("open", ["open software licen[sc]e"]),
    "afl": ("academic", ["academic free licen[sc]e"]),
    "upl": ("permissive", ["universal permissive licen[sc]e"]),
    "beerware": ("beerware", ["beerware licen[sc]e", "beerware"]),
    "cc-by": ("cc", ["cc by"]),
    "cc-by-sa": ("cc", ["cc by sa"]),
    "cc-by-nc": ("cc", ["cc by nc"]),
    "cc-by-nd": ("cc", ["cc by nd"]),
    "cc-by-nc-sa": ("cc", ["cc by nc sa"]),
    "cc-by-nc-nd": ("cc", ["cc by nc nd"]),
    "cc0": ("cc0", ["cc0"]),
    "cc": ("creative", ["creative commons attribution", "creative commons licen[sc]e", "creative commons"]),
    "public-domain": ("domain", ["public domain"]),
    "proprietary": ("rights", ["all rights reserved"]),
}

# Ways in which a name stands in a notice: text before it, text after it, priority, weight.
_FRAMES = [
    (r"licen[sc]ed under(?: the)?(?: terms of)?(?: the)?", "", 40, 0.9),
    (r"(?:released|distributed|available|published|provided) under(?: the)?(?: terms of)?(?: the)?", "", 40, 0.85),
    (r"(?:subject to|according to|governed by)(?: the)?(?: terms of)?(?: the)?", "", 35, 0.8),
    ("", "as published by", 35, 0.85),
    (r"(?:see|read|a copy of|copy of)(?: the)?", "", 25, 0.6),
    (r"spdx licen[sc]e identifier", "", 50, 0.98),
    ("", "", 10, 0.5),
]

_LETTERS_OF = {"gpl-short": "gpl", "lgpl-library": "lgpl", "lgpl-short": "lgpl", "agpl-short": "agpl"}


def _words(written: str) -> str:
    return written.replace(" ", _GAP)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules: each name of each family in each frame, then clauses of well-known texts."""
    found = []
    for family, (keyword, names) in _FAMILIES.items():
        label = _LETTERS_OF.get(family, family)
        for name in names:
            for before, after, priority, weight in _FRAMES:
                pattern = _words(name) + _VERSION + (_GAP + _words(after) if after else "")
                if before:
                    pattern = _words(before) + _GAP + pattern
                pattern = rf"(?<![0-9a-z]){pattern}(?![0-9a-z])"
                found.append(Rule(label, keyword, pattern, priority + len(name.split()), weight))
    clauses = [
        ("mit", "hereby", "permission is hereby granted, free of charge, to any person obtaining a copy", 60, 0.97),
        ("isc", "permission", "permission to use, copy, modify, and/or distribute this software for any purpose", 60, 0.97),
        ("bsd", "redistribution", "redistribution and use in source and binary forms", 60, 0.97),
        ("zlib", "altered", "altered source versions must be plainly marked as such", 60, 0.95),
        ("unlicense", "unencumbered", "free and unencumbered software released into the public domain", 60, 0.97),
        ("gpl", "redistribute", "you can redistribute it and/or modify it under the terms of the gnu", 58, 0.9),
        ("boost", "organization", "permission is hereby granted, free of charge, to any person or organization", 61, 0.95),
        ("apache", "compliance", "you may not use this file except in compliance with the license", 60, 0.9),
    ]
    for label, keyword, text, priority, weight in clauses:
        pattern = _GAP.join(re.findall(r"[0-9a-z]+", text))
        found.append(Rule(label, keyword, rf"(?<![0-9a-z]){pattern}(?![0-9a-z])", priority, weight))
    return tuple(found)


def _hash(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return Rolling(data).of(ends - [len(w.encode()) for w in words], ends)


@lru_cache(maxsize=1)
def _prepared():
    by_keyword: dict[str, list[tuple[Rule, re.Pattern]]] = {}
    for rule in rules():
        by_keyword.setdefault(rule.keyword, []).append((rule, re.compile(rule.pattern)))
    words = sorted(by_keyword)
    phrases = [(label, _hash(phrase.split())) for phrase, label in PHRASES.items()]
    codes = _hash(words)
    sieve = np.zeros(1 << 16, bool)
    sieve[(codes >> np.uint64(48)).astype(np.int64)] = True
    firsts = np.zeros(1 << 16, bool)
    firsts[[int(h[0] >> np.uint64(48)) for _, h in phrases]] = True
    return by_keyword, dict(zip(codes.tolist(), words)), sieve, phrases, firsts


def detect(text: str, keywords: set[str]) -> list[tuple[int, int, Rule]]:
    """Detections (start, end, rule) of the rules with these keywords, after suppression."""
    by_keyword = _prepared()[0]
    hits = []
    for keyword in keywords:
        for rule, pattern in by_keyword[keyword]:
            hits += [(m.start(), m.end(), rule) for m in pattern.finditer(text)]
    hits.sort(key=lambda h: (-h[2].priority, h[0] - h[1], h[0], h[2].label))
    kept: list[tuple[int, int, Rule]] = []
    # The furthest end of those kept, by ranges of starts (a binary indexed tree), so that many hits stay cheap.
    place = {start: n for n, start in enumerate(sorted({h[0] for h in hits}), 1)}
    furthest = [-1] * (len(place) + 1)
    for start, end, rule in hits:
        n, until = place[start], -1
        while n:
            until = max(until, furthest[n])
            n &= n - 1
        if until < end:
            kept.append((start, end, rule))
            n = place[start]
            while n < len(furthest):
                furthest[n] = max(furthest[n], end)
                n += n & -n
    return sorted(kept, key=lambda h: (h[0], h[1]))


def _scan(array: pa.Array):
    _, by_code, sieve, phrases, firsts = _prepared()
    n = len(array)
    n_words, n_base = np.zeros(n, np.int64), np.zeros(n, np.int64)
    first_word, last_word = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    base: list[set[str]] = [set() for _ in range(n)]
    labels: list[str] = [""] * n
    spans: list[list[dict]] = [[] for _ in range(n)]
    score = np.zeros(n)
    for first, last, data, offsets in blocks(array):
        data = _LOWER[data]
        starts, ends, bounds = runs(_WORD[data], offsets)
        n_words[first:last] = np.diff(bounds)
        codes = Rolling(data).of(starts, ends)
        top = (codes >> np.uint64(48)).astype(np.int64)
        for label, words in phrases:
            at = np.flatnonzero(firsts[top])
            at = at[at + len(words) <= len(codes)]
            for k, word in enumerate(words):
                at = at[codes[at + k] == word]
            doc = np.searchsorted(bounds, at, "right") - 1
            whole = at + len(words) <= bounds[doc + 1]
            for i, d in zip(at[whole].tolist(), doc[whole].tolist()):
                word, d = i - int(bounds[d]), d + first
                n_base[d] += 1
                first_word[d] = word if first_word[d] < 0 else min(first_word[d], word)
                last_word[d] = max(last_word[d], word)
                base[d].add(label)
        seen: dict[int, set[str]] = {}
        maybe = np.flatnonzero(sieve[top])
        doc = np.searchsorted(bounds, maybe, "right") - 1
        for code, d in zip(codes[maybe].tolist(), doc.tolist()):
            if code in by_code:
                seen.setdefault(d, set()).add(by_code[code])
        for d, keywords in seen.items():
            raw = data[offsets[d] : offsets[d + 1]].tobytes().decode()
            found = detect(raw, keywords)
            labels[first + d] = ",".join(sorted(base[first + d] | {r.label for _, _, r in found}))
            spans[first + d] = [{"start": a, "end": b, "label": r.label} for a, b, r in found]
            score[first + d] = 1 - np.prod([1 - r.weight for r in {r for _, _, r in found}])
        for d in range(first, last):
            if base[d] and not labels[d]:
                labels[d] = ",".join(sorted(base[d]))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string())]))
    return None, [
        pa.array(n_words),
        pa.array(n_base),
        pa.array(first_word, mask=n_base == 0),
        pa.array(last_word, mask=n_base == 0),
        pa.array([",".join(sorted(b)) for b in base], pa.string()),
        pa.array(labels, pa.string()),
        pa.array(score),
        pa.array(spans, kind),
    ]


def scan_licenses(docs: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """Per document: words, places of the fixed phrases, labels, score and the detections (code points)."""
    schema = (
        "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
        "score double, detections array<struct<start: int, end: int, label: string>>"
    )
    return map_texts(docs, _scan, schema, id_col, text_col)
