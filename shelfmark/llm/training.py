"""Labelled rows to learn from, in a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.storage import keep

TRAIN_ROWS = 20_000  # labelled rows learned from, in expectation; all of them if there are fewer


def labelled(docs: DataFrame, labels: DataFrame, label: str, learns: Column, name: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` columns and ``label`` (0 or 1) of the rows that may be learned from.

    Ids are drawn by hash, so the sample is the same in every run; an id with several labels
    counts by its largest. The ids and labels are at most about ``rows`` small rows: they are
    broadcast, so no text is shuffled.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & learns).groupBy("doc_id").agg(F.max(label).alias(label))
    usable = keep(usable, f"{name}-labels")
    share = min(1.0, rows / max(1, usable.count()))
    drawn = usable.where(F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    return keep(docs.drop(label).join(F.broadcast(drawn), "doc_id"), f"{name}-train")
