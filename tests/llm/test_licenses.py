import re
import time

from stowage.llm import licenses
from stowage.llm.queries import op6_licenses

SF = "/root/testdata/sf0.001"


def brute(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def check(rows, texts):
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows]
    assert sorted(got, key=str) == sorted(((d, *brute(t)) for d, t in texts), key=str)
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert r.labels == ",".join(sorted(set(r.labels.split(",")))) and 0 <= r.score <= 1


def test_query_equals_plain_matching(spark, documents):
    check(op6_licenses(spark, SF).collect(), [(r.doc_id, r.text) for r in documents.collect()])


def test_awkward_rows(spark, awkward):
    more = [
        (20, "CC BY\ncc-by,CC BY gnu general public"), (21, "GNU  General/Public\nLICENSE"), (22, "licence éapache license"),
        (23, "apache"), (24, "license mit"), (25, "the MIT license. MIT LICENSE! apache license"),
    ]
    docs = awkward.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    check(licenses.scan_licenses(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    check(licenses.scan_licenses(awkward).collect(), [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()])


def test_empty_table(empty):
    assert licenses.scan_licenses(empty).count() == 0


def found(text):
    lower = text.lower()
    keywords = {r.keyword for r in licenses.rules()}
    return licenses.detect(lower, {k for k in keywords if re.search(rf"(?<![0-9a-z]){k}(?![0-9a-z])", lower)})


def test_rules():
    assert len(licenses.rules()) > 300
    assert {r.label for _, _, r in found("Licensed under the Apache License, Version 2.0.")} == {"apache"}
    assert {r.label for _, _, r in found("SPDX-License-Identifier: LGPL-2.1")} == {"lgpl"}
    text = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    assert {r.label for _, _, r in found(text)} == {"mit"}
    assert found("a sentence about generals and the public") == []


def test_containment_and_priority():
    # the longer name holds the shorter one
    assert [r.label for _, _, r in found("gnu lesser general public license")] == ["lgpl"]
    assert [r.label for _, _, r in found("gnu affero general public license, version 3")] == ["agpl"]
    spans = [(a, b) for a, b, _ in found("licensed under the mit license and the apache license")]
    assert len(spans) == 2 and spans[0][1] <= spans[1][0]


def test_a_keyword_is_in_every_match():
    """The prefilter leaves no match out: each rule's keyword is a word of the shortest text it matches."""
    for family, (keyword, names) in licenses._FAMILIES.items():
        for name in names:
            assert keyword in re.sub(r"\[sc\]", "s", name).split() or keyword in name, (family, name)


def test_many_detections_in_one_text_stay_cheap():
    keywords = {k for k, rules in licenses._prepared()[0].items() if any(r.label == "mit" for r, _ in rules)}
    start = time.perf_counter()
    found = licenses.detect("mit license " * 40_000, keywords)
    assert len(found) >= 39_999
    assert time.perf_counter() - start < 30


def test_containment_against_every_pair():
    text = "licensed under the mit license, apache license 2.0 and mit license; gnu general public license v3 " * 5
    by_keyword = licenses._prepared()[0]
    hits = [(m.start(), m.end(), r) for rules in by_keyword.values() for r, p in rules for m in p.finditer(text)]
    hits.sort(key=lambda h: (-h[2].priority, h[0] - h[1], h[0], h[2].label))
    kept = []
    for start, end, rule in hits:
        if not any(a <= start and end <= b for a, b, _ in kept):
            kept.append((start, end, rule))
    assert licenses.detect(text, set(by_keyword)) == sorted(kept, key=lambda h: (h[0], h[1]))
