import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from stowage.llm import pii
from stowage.llm.queries import op4_pii

SF = "/root/testdata/sf0.001"

# The base patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, m.end(), kind))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


HARD = [
    None, "", "a@b.cd_x@e.f", "a@b@c.de x..y@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.000255 1.2.3",
    "+1 (437) 555-0689 ndre +123 ++1-234-567-890 ", "4111 1111 1111 1111 4111-1111-1111-1112 1 2",
    "😀é a.b@c.de 😀 8.8.8.8", "x" * 20000, "1" * 9000, "1 " * 2000, "@" * 500, "+1" + " " * 3000,
    "a." * 3000 + "@b.c", "1." * 2000, "+4111111111111111 4111111111111111@x.y 4111111111111111.2.3.4",
]


def hard(spark):
    return spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")


def test_base_spans_equal_the_patterns(spark, awkward, documents):
    for docs in (hard(spark), awkward, documents):
        texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = pii.find(docs).select("doc_id", pii.written("base").alias("base")).collect()
        want = [(d, ",".join(base_spans(t))) for d, t in texts]
        assert sorted(((r.doc_id, r.base) for r in got), key=str) == sorted(want, key=str)


def test_query(spark, documents):
    rows = {r.doc_id: r for r in op4_pii(spark, SF).collect()}
    for doc in documents.collect():
        spans, row = base_spans(doc.text), rows[doc.doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        counts = [sum(s.startswith(kind + ":") for s in spans) for kind in PATTERNS]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        everything = row.spans.split(",") if row.spans else []
        assert set(spans) <= set(everything)
        # the only other personal data of these documents
        for m in re.finditer(r'token = "([0-9a-f]{20,})"', doc.text):
            assert f"secret:{m.start(1)}:{m.end(1)}" in everything
        assert all(s in spans or s.startswith("secret:") for s in everything)


def test_no_python_in_the_plan(documents):
    plan = pii.redact(documents, pii.fit(pii.find(documents)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_found_kinds_and_redaction(spark, documents, awkward):
    text = 'SSN: 123-45-6789, born 1980-02-03. IBAN DE89 3704 0044 0532 0130 00. token = "ffc3105535f423f352535e4ac5" a@b.cd'
    docs = documents.select("doc_id", "text").union(spark.createDataFrame([(-1, text)], "doc_id long, text string"))
    model = pii.fit(pii.find(docs))
    clean = pii.redact(docs, model).where("doc_id = -1").first().text
    assert clean == 'SSN: <identity>, born <birth>. IBAN <account>. token = "<secret>" <email>'
    same = pii.redact(awkward, model)
    assert same.columns == awkward.columns and same.count() == awkward.count()
    assert same.exceptAll(awkward).isEmpty()
    overlap = spark.createDataFrame([(1, "x +4111111111111111 y")], "doc_id long, text string")
    assert pii.redact(overlap, model).first().text in ("x <card> y", "x <phone> y", "x +<card> y")


def test_empty_table(empty):
    assert pii.redact(empty, pii.fit(pii.find(empty))).count() == 0


def test_reliabilities_of_known_labelers():
    """Three labelers of accuracy 0.9, 0.8 and 0.6 vote on 20,000 spans."""
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.4
    accuracy = np.array([0.9, 0.85, 0.65])
    votes = np.where(rng.random((20000, 3)) < accuracy, truth[:, None], ~truth[:, None]).astype(int)
    patterns, inverse, mass = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, right = pii.reliabilities(patterns, mass.astype(float))
    assert np.abs(right - accuracy).max() < 0.06
    assert ((posterior[inverse.ravel()] > 0.5) == truth).mean() > 0.88


def test_spans_are_sorted(documents):
    found = pii.find(documents)
    rows = pii.spans(found, pii.fit(found)).select(F.transform("spans", lambda s: F.struct(s["start"], s["rank"])).alias("s")).collect()
    assert all(list(r.s) == sorted(r.s) for r in rows)
