"""The registered queries of the operators, over the whole of their tables."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stowage.llm import (
    bpe,
    decontam,
    jaccard,
    langid,
    licenses,
    neighbours,
    packing,
    periodic,
    pii,
    quality,
    repeats,
    toxicity,
    variants,
)
from stowage.llm.learn import remainder
from stowage.llm.tables import read, scratch

#: Where the vocabulary of the packing query lies; any path that all executors see.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    model = langid.learn(docs, ~held_out, remainder("doc_id", 64) == 1)
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(read(spark, sf_dir, "documents"), tokenizer_path())
    digest = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digest)


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"), n=4, similar=85)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scratch(spark).table(pii.find(read(spark, sf_dir, "documents")).drop("text"), "found")
    rows = pii.spans(found, pii.fit(found))
    counts = [pii.of_kind("base", kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return rows.select(
        "doc_id", *counts, F.sha2(pii.written("base"), 256).alias("base_sha256"), pii.written("spans").alias("spans")
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = scratch(spark).table(quality.statistics(read(spark, sf_dir, "documents")), "statistics")
    held_out = remainder("doc_id", 3) == 1
    rules = quality.learn(measured, read(spark, sf_dir, "labels").where(~held_out), "quality")
    scored = quality.score(measured, rules)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents")).drop("detections")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read(spark, sf_dir, "documents"), remainder("doc_id", 3) == 1
    labelled = toxicity.labelled_texts(docs, read(spark, sf_dir, "labels").where(~held_out), "toxic")
    signs = toxicity.choose(labelled)
    voted = scratch(spark).table(toxicity.votes(docs, signs), "votes")
    classifier = toxicity.learn(voted, labelled, signs)
    scored = voted.select("doc_id", held_out.alias("held_out"), classifier.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op8_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = repeats.remove_repeats(read(spark, sf_dir, "documents"))
    return rest.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def periodic_ends() -> Column:
    """``text`` of documents; with a tenth of the identifiers, from some word on it repeats the words that stand there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def with_end(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: (a + (i - a) % p + 1).cast("int")
        moved = F.transform(words, lambda word, i: F.when(i >= a, F.get(words, place(i) - 1)).otherwise(word))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise("")

    words = F.filter(F.split("text", "[\\x09-\\x0D\\x20]+", -1), lambda word: word != "")
    # the words are a variable of the function, so that they are not split anew for each of them
    return F.when(h % 10 == 0, F.transform(F.array(words), with_end)[0]).otherwise(F.col("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", periodic_ends().alias("text"))
    found = periodic.periodic_runs(docs)
    line = lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "start",
        "length",
        "period",
        F.floor(1000 * F.col("length") / F.col("period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def misspelt(doc_id: int | None, word: str) -> str:
    """``word`` of a document; about one in a hundred lacks a code point."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if doc_id is None or h % 97:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.count_words(read(spark, sf_dir, "documents"), change=misspelt)
    return variants.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(read(spark, sf_dir, "documents"), tokenizer_path(), both=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_packing": op2_packing,
    "op3_jaccard": op3_jaccard,
    "op4_pii": op4_pii,
    "op5_quality": op5_quality,
    "op6_licenses": op6_licenses,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_repeats": op8_suffix_repeats,
    "op9_neighbours": op9_neighbours,
    "op10_decontamination": op10_decontamination,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_bpe": op13_bpe,
}

ORACLES: dict[str, str] = {}
