"""Corpus pipeline over ``documents``: quality rules, near duplicates,
repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on everything that its
predecessor kept; the result is written as Parquet and read again before the
next stage.  All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.llm import genetic_packing, ngram_join, quality_forest, repeats, secret_forest
from quillstream.llm.catalog import read, vocabulary
from quillstream.llm.scratch import cut, free_name


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where the table has it."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.select(*(length.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the isolation forest, which is
    fitted on the labelled documents among ``docs``.  Null and empty texts
    have too few words and go; each row is judged by its own text, so rows
    with a null or repeated id stay or go one by one."""
    forest = quality_forest.fit_forest(docs, read(spark, sf_dir, "labels"))
    return quality_forest.filter_quality(docs, forest)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every near-duplicate group.

    Of rows with one id one stays.  Rows without an id have no place in that
    order: they go if their text is a copy of a row with one, and of equal
    ones among them one stays; near copies among them stay.  Null texts and
    texts without words are duplicates of nothing."""
    groups = ngram_join.ngram_jaccard_components(docs.where("doc_id is not null"))
    gone = groups.where("doc_id != component_id").select("doc_id")
    again = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = cut(again.join(gone, "doc_id", "left_anti"), "repeated_ids")
    dropped = cut(gone.union(again).distinct(), "dropped_ids")
    kept = docs.where("doc_id is not null").join(dropped, "doc_id", "left_anti")
    single = docs.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    nameless = docs.where("doc_id is null")
    worded = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    # by digest: no text is shuffled for it
    digest = F.unhex(F.sha2(F.col("text"), 256))
    known = docs.where("doc_id is not null").select(digest.alias(free_name("digest", docs.columns)))
    own = nameless.where(worded).withColumn(known.columns[0], digest).dropDuplicates(known.columns)
    fresh = own.join(known, known.columns[0], "left_anti")
    found = kept.select(docs.columns).unionByName(single.select(docs.columns))
    return found.unionByName(fresh.select(docs.columns)).unionByName(nameless.where(~worded))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that an earlier document has, each row
    one by one.  Rows without an id have no place in the order: they neither
    lose bytes nor make others lose them.  Null and empty texts stay."""
    return _with_length(repeats.remove_repeats(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with the found secrets replaced, in rows without an id as well;
    no row goes."""
    return _with_length(secret_forest.redact_secrets(docs, secret_forest.scan_secrets(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's place in sequences of at most 2048 tokens, rows
    with a null id and null texts (which are their end token) included."""
    return genetic_packing.pack_documents(docs, vocabulary(), capacity=2048, end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secrets", secrets),
    ("packing", packing),
]

#: A trained forest decides in two stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = cut(docs, name)
    return docs
