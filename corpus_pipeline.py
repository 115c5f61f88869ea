"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, as a table of its own, and its decisions
take effect: documents of low quality go, one document of each group of near copies
stays, documents with a benchmark passage go, personal data is replaced by its kind,
and what is left is tokenised and packed. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stowage.llm import decontam, jaccard, packing, pii, quality
from stowage.llm.learn import bounded_sample, remainder
from stowage.llm.queries import tokenizer_path
from stowage.llm.tables import read, scratch

#: Identifiers that may go to all tasks, in bytes; beyond that, documents are shuffled to them.
IDS_BYTES = 16 << 20
KEY_BYTES = 64  # of an identifier with the digest of a text, about


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a quality score below 0.5; rules come from labelled rows outside the held-out third.

    Null and empty texts are scored by the same rules as texts without a word. Rows are
    judged one by one, so repeated rows and those that share an identifier, or lack it, stay or
    go by their texts; labels with several values for an identifier all count. Without labels
    every document scores 0.5 and stays. An empty table gives none.
    """
    labels = read(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1).where("quality in (0, 1)")
    labels = bounded_sample(labels, quality.LABEL_ROWS, labels.count(), "doc_id").select("doc_id", "quality")
    # at most about LABEL_ROWS rows of two numbers
    texts = docs.join(F.broadcast(labels.select("doc_id").distinct()), "doc_id", "left_semi")
    rules = quality.learn(quality.statistics(texts), labels, "quality")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    scored = quality.statistics(rows, id_col="row").where(rules.score() >= 0.5)
    return scored.select(F.col("doc_id.*"))


def _by_key(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` with, or without, the rows whose key is among ``keys`` (doc_id and digest of the text, distinct)."""
    keys = F.broadcast(keys) if keys.count() * KEY_BYTES <= IDS_BYTES else keys
    alike = docs["doc_id"].eqNullSafe(keys["_id"]) & _digest(docs["text"]).eqNullSafe(keys["_digest"])
    return docs.join(keys, alike, how)


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("string").cast("binary")))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 or more over five-word shingles, the one of least identifier.

    Rows are told apart by identifier and text: of one identifier with several texts,
    those that are copies go and others stay, and of copies under one identifier one
    text stays. A row repeated with both stays once. A document without an identifier
    comes after all that have one. Documents without a word stay; those that lack an
    identifier as well are not taken for repeats.
    """
    kept = scratch(spark)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", _digest(F.col("text")).alias("digest"))
    keyed = docs.select(key.alias("key"), "text")
    found = kept.table(jaccard.near_duplicates(keyed, id_col="key"), "groups").withColumnRenamed("doc_id", "key")
    names = [F.col("key.doc_id").alias("_id"), F.col("key.digest").alias("_digest")]
    copies = found.where("n_shingles > 0 and component_id != key").select(*names).distinct()
    stay = found.where("n_shingles > 0 and component_id = key or n_shingles = 0 and not key.none")
    twice = stay.groupBy("key").count().where("count > 1").select(*names)
    rest = _by_key(docs, kept.table(copies, "copies"), "left_anti")
    twice = kept.table(twice, "twice")
    if twice.isEmpty():
        return rest
    repeated = _by_key(rest, twice, "left_semi").dropDuplicates(["doc_id", "text"])
    return _by_key(rest, twice, "left_anti").unionByName(repeated)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage within a small edit distance of a benchmark item.

    Null and empty texts hold none and stay. Rows are judged one by one, whatever their
    identifiers; repeated rows stay or go together. An empty table gives none.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    counted = decontam.count_leaks(rows, read(spark, sf_dir, "benchmark"), id_col="row")
    return counted.where("n_items = 0").select(F.col("doc_id.*"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in angle brackets.

    All rows stay, with all their columns; null and empty texts stay as they are. Spans that
    overlap become one, of the kind of the first; of equal starts, of the kind listed first.
    Identifiers take no part. An empty table gives none.
    """
    return pii.redact(docs, pii.fit(pii.find(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise, and place the pieces in sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are pieces of the closing token alone. Rows with equal or null
    identifiers are documents of their own; which sequence equal lengths go to is open. An empty table gives none.
    """
    pieces = packing.tokenize(docs, tokenizer_path())
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("pii", redact),
    ("packing", pack),
]

#: No stage but the last can be written in SQL; tests compare them with plain programs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; between stages a table is written to the shared folder."""
    tables = scratch(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = tables.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
