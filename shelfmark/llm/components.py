"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.storage import bounded, keep


def components(links: DataFrame) -> DataFrame:
    """id, component (the least id reachable) for every id in ``links`` (a, b).

    Each pass lets every component point to the least of its neighbours and itself, follows
    pointers twice, and rewrites the links between components; what is left shrinks by a
    constant factor at least, so passes grow with the logarithm of the longest chain. Labels
    and links stay tables in the shared folder; the driver gets one flag a pass.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = bounded(keep(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")), "labels"))
    edges = links.select("a", "b")
    while True:
        at = lambda side: labels.select(F.col("id").alias(side), F.col("component").alias(f"c{side}"))
        edges = edges.join(at("a"), "a").join(at("b"), "b").where("ca <> cb").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()
        edges = bounded(keep(edges, "links"))
        # a label that itself has moved on is followed before the next pass
        moved = labels.where("id <> component").select(F.col("id").alias("component"), F.col("component").alias("next"))
        pending = labels.join(moved, "component", "left_semi")
        if edges.isEmpty() and pending.isEmpty():
            return labels
        pull = edges.select("b", "a").union(edges.select(F.col("a").alias("b"), F.col("b").alias("a"))).groupBy("b").agg(F.min("a").alias("m"))
        pull = pull.where("m < b").select(F.col("b").alias("component"), F.col("m").alias("next"))
        step = keep(labels.select(F.col("id").alias("component"), F.col("component").alias("next")).where("component <> next").unionByName(pull)
                    .groupBy("component").agg(F.min("next").alias("next")), "pointers")
        step = bounded(step)
        for _ in range(2):
            onward = step.select(F.col("component").alias("next"), F.col("next").alias("_onward"))
            step = step.join(onward, "next", "left").select("component", F.coalesce("_onward", "next").alias("next"))
        step = bounded(keep(step, "pointers"))
        labels = bounded(keep(labels.join(step, "component", "left").select("id", F.coalesce("next", "component").alias("component")), "labels"))
