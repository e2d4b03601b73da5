"""The corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet
and read again as the next one's ``docs``. All stages but the last return the columns of
``documents``. Rows without id are never linked or counted as copies; extra columns of ``docs``
are carried through by every stage.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import decontamination, mixing, near_duplicates, substrings, toxicity
from shelfmark.llm.storage import bounded, distil, free_name, keep, one_row_per_id, remainder, table, with_names

TOXIC = 0.5  # score from which a document is rejected
SENT_IDS = 2_000_000  # ids of dropped documents up to which they may be broadcast (about 130 MB); with more, texts move
NEAR = 80  # percent of shingles in common from which documents are near-duplicates


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under TOXIC. The grammar is learned from the labelled rows
    of ``docs``, those held out from the toxicity query left aside; without labels all stay."""
    model, score = toxicity.learn(docs, table(spark, sf_dir, "labels"), remainder(5) != 0), free_name(docs, "toxicity")
    return toxicity.score_toxicity(docs, model, score).where(F.col(score) < TOXIC).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group. Different texts that share an id are documents
    of their own; of rows equal in id and text one stays, and rows without id all stay."""
    name = free_name(docs, "name")
    named = with_names(docs, name)
    texts = named.select(F.col(name).alias("doc_id"), "text")
    dropped = distil(spark, lambda: near_duplicates.near_duplicates(texts, NEAR).where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct(), "dropped")
    dropped = bounded(dropped, SENT_IDS)
    return one_row_per_id(named.join(dropped, name, "left_anti"), name).select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one with a smaller id has; n_chars is counted anew for
    texts that lost some, and documents that nothing is left of go."""
    spans, changed = distil(spark, lambda: substrings.repeated_spans(docs), "spans"), free_name(docs, "changed")
    cut = substrings.without_spans(docs, spans, changed).where(~F.col(changed) | (F.length("text") > 0))
    return cut.withColumn("n_chars", F.when(F.col(changed), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    leaks = free_name(docs, "leaks")
    judged = decontamination.with_leaks(docs, table(spark, sf_dir, "benchmark"), into=leaks)
    return judged.where(F.size(leaks) == 0).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``copies``, how often, and ``taken``, the words that
    makes (own columns of these names are replaced); documents with no copy go. Of rows equal in
    id and text one stays; other rows that share an id, and rows without id, are documents of
    their own."""
    name, row, no_id = (free_name(docs, c) for c in ("name", "mix_row", "mix_no_id"))
    once = one_row_per_id(with_names(docs, name), name)
    # rows without id are numbered; that is stored, as it depends on how files are split
    unnamed = keep(once.where(F.col(name).isNull()).withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    once = once.where(F.col(name).isNotNull()).withColumn(row, F.col(name)).unionByName(unnamed).drop(name)
    taken = distil(spark, lambda: mixing.mix(once, row=row).where(F.col("copies") > 0).select(row, F.col("doc_id").isNull().alias(no_id), "copies", "taken"), "mix")
    return once.drop("copies", "taken").withColumn(no_id, F.col("doc_id").isNull()).join(taken, [row, no_id]).drop(row, no_id)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", cut_repeats),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: The toxicity score and the cuts of a rolling hash are no SQL; tests hold each stage against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = distil(spark, partial(stage, spark, docs, sf_dir), f"stage-{name}")
    return docs
