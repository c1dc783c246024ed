"""Training-corpus pipeline over ``documents``.

Stages, in order: language ID, n-gram Jaccard near-duplicates, repeated
substrings, benchmark decontamination, mixing sources.  Each takes ``(spark,
docs, sf_dir)`` and returns a DataFrame; its output is written as Parquet and
reread as the next one's ``docs``.  All but the last return the columns of
``documents``; the last returns the mix: words taken of every document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldload.llm import decontaminate, langid, mixing, ngram_join, substrings
from fieldload.llm.queries import bounded_batches, table
from fieldload.llm.sketch import by_membership
from fieldload.operators.stage import cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language; null, empty and letterless texts go."""
    bounded_batches(spark)
    return langid.identify(docs.select(*COLUMNS)).where(F.col("lang_pred") != langid.UNKNOWN).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked documents, of the smallest id; of that id's rows the one with the least text hash.

    Rows that repeat an id are documents of their own: one goes only when its
    text equals or is linked to that of a row that stays.  Of rows with equal
    id and text the least (source, lang, n_chars) stays.  Rows with a null id
    stay; texts without words are compared for equality only.
    """
    bounded_batches(spark)
    docs = docs.select(*COLUMNS)
    found = ngram_join.jaccard_components(docs, with_keys=True).where("doc_id is not null")
    # Rows of one id and text are in one group.
    texts = cut(
        found.groupBy("doc_id", "text_key").agg(
            *[F.min(c).alias(c) for c in ("n_shingles", "component_id", "group_key")], F.count("*").alias("rows")
        ),
        "document-texts",
    )
    first = texts.where("n_shingles > 0 and doc_id = component_id").groupBy("group_key", "doc_id").agg(F.min("text_key").alias("text_key"))
    judged = texts.join(first.select("doc_id", "text_key", F.lit(True).alias("is_first")), ["doc_id", "text_key"], "left").select(
        F.col("doc_id").alias("id"), "text_key", "rows", F.expr("n_shingles = 0 or is_first is not null").alias("stays")
    )
    special = cut(judged.where("not stays or rows > 1").drop("rows"), "duplicates")
    keyed = docs.withColumn("key", F.xxhash64("text"))
    clear, maybe = by_membership(keyed, F.xxhash64("doc_id", "key"), special.select(F.xxhash64("id", "text_key").alias("key")))
    same = (F.col("doc_id") == F.col("id")) & (F.col("key") == F.col("text_key"))
    some = maybe.join(special.hint("shuffle_hash"), same, "left")
    once = some.where("stays").groupBy("doc_id", "text").agg(F.min(F.struct("source", "lang", "n_chars")).alias("r"))
    once = once.select("doc_id", "text", "r.lang", "r.source", "r.n_chars")
    return clear.select(*COLUMNS).unionByName(some.where("id is null").select(*COLUMNS)).unionByName(once)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that an earlier document has; others keep their text as it is."""
    bounded_batches(spark)
    found = substrings.remove_repeats(docs.select(*COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return found.withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast("long")
    ).select(*COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    bounded_batches(spark)
    found = decontaminate.find_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.where("n_hit = 0").select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, size, source_size, target, quota, taken`` of every document left."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language),
    ("ngram_jaccard", near_duplicates),
    ("substring_dedup", repeated_substrings),
    ("decontamination", benchmark_leaks),
    ("source_mix", source_mix),
]

# Language ID is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``; every stage reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
