"""Mix sources to target weights by balanced sampling (the cube method).

A source's rate is its target over its size. A document gets the whole part of the rate as sure
copies, and one more with the fractional part as inclusion probability. The flight phase moves
the fractional probabilities of three documents at a time along the null space of two
constraints, words and documents, until one of the three is 0 or 1; so both totals stay exact.
It runs in blocks of hashed documents of one source; what stays fractional in a block, two
documents at most, goes to the blocks of the next level, until a source is a single block. There the
landing phase rounds the last two and turns over single documents of that block, so that the
words come closest to the target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.storage import keep
from shelfmark.llm.words import to_bytes
from shelfmark.operators.ranking import numbered

WEIGHTS = (5, 2, 1)  # of the sources in code-point order, repeating
MOST = 3  # times its size that a source, and so a document, is taken at most
BLOCK = 2000  # expected documents of a flight block
FLIPS = 8  # single documents that the landing turns over at most
EPS = 1e-9


def sized(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, source, size (words; 0 for null), key: a hash that orders the documents; and ``row``."""

    @F.pandas_udf("long")
    def n_words(texts: pd.Series) -> pd.Series:
        return pd.Series([len(to_bytes(t).split()) for t in texts], dtype="int64")

    return docs.select("doc_id", "source", n_words("text").alias("size"), *[row] * bool(row)).withColumn("key", F.xxhash64("doc_id", "size"))


def targets(sizes: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size, target: shares by weight, none above ``most`` times its source's size.

    Each pass fixes the sources whose share is too large at their limit and shares what is left
    by weight; a pass brings three numbers to the driver.
    """
    sums = keep(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    # null sorts last; the flag keeps it apart from any text
    ranked = numbered(sums, [F.col("source").isNull(), F.col("source")])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("row_num") - 1) % len(weights) + 1).cast("int"))
    state = keep(ranked.select("source", "source_size", weight.alias("weight"), (most * F.col("source_size")).cast("double").alias("limit")), "source-weights")
    total = state.agg(F.sum("source_size")).first()[0] or 0
    per_weight = 0.0
    fixed = F.lit(False)
    left = None
    while True:
        now = state.agg(F.sum(F.when(fixed, F.col("limit"))).alias("used"), F.sum(F.when(~fixed, F.col("weight"))).alias("weight"), F.count(F.when(~fixed, 1)).alias("free")).first()
        if now.free == left or not now.free:
            break
        left, per_weight = now.free, (total - (now.used or 0.0)) / now.weight
        fixed = F.col("limit") <= F.col("weight") * per_weight  # shares only rise from pass to pass
    return state.select("source", "source_size", F.least("limit", F.col("weight") * per_weight).alias("target"))


def flight(sizes: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Probabilities after the flight phase: 0 or 1 but for two at most, and the same sums of p
    and of p * sizes. Units are taken in the given order, so the last ones stay open. The
    direction of a move is drawn from a generator that the units seed."""
    p = p.astype(float).tolist()
    s = sizes.astype(float).tolist()
    draw = np.random.default_rng([len(p), int(sizes.sum()) & 0xFFFFFFFF]).random(2 * len(p) + 4).tolist()
    active: list[int] = []
    steps = iter(draw)
    for i in range(len(p)):
        active.append(i)
        while len(active) == 3:
            a, b, c = active
            u = (s[b] - s[c], s[c] - s[a], s[a] - s[b])
            if u == (0.0, 0.0, 0.0):
                u = (1.0, -1.0, 0.0)
            up = min((1 - p[k]) / x if x > 0 else -p[k] / x for k, x in zip(active, u) if x)
            down = min(p[k] / x if x > 0 else (p[k] - 1) / x for k, x in zip(active, u) if x)
            step = up if next(steps, 0.5) * (up + down) < down else -down
            for k, x in zip(active, u):
                p[k] = min(1.0, max(0.0, p[k] + step * x))
                if p[k] < EPS or p[k] > 1 - EPS:
                    p[k] = float(round(p[k]))
            active = [k for k in active if 0 < p[k] < 1]
    return np.array(p)


def land(sizes: np.ndarray, p: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Round what the flight left open, then turn single documents over while that brings the
    words closer to their expected total; the document total gives way, by a few at most.

    ``start``: the probabilities before the flight, whose words are the total to meet. Large
    documents stay open longest, so rounding alone could miss it by half of a large one.
    """
    p = np.where(p >= 0.5, 1.0, 0.0)
    over = float(((p - start) * sizes).sum())
    for _ in range(FLIPS):
        after = np.abs(over + np.where(p > 0, -1.0, 1.0) * sizes)
        k = int(after.argmin()) if len(after) else 0
        if not len(after) or after[k] >= abs(over) - EPS:
            break
        over += -sizes[k] if p[k] > 0 else sizes[k]
        p[k] = 1 - p[k]
    return p


def mix(docs: DataFrame, weights=WEIGHTS, most: float = MOST, block: int = BLOCK, row: str | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row for each input row.

    ``copies`` is how often the mix takes the document, ``taken`` the words that makes. Null and
    empty texts have size 0: they are taken at their source's rate and add no words. A null
    source is a source like others. Rows that repeat (or have no id) are documents of their own,
    in an order of hashed id and size; equal ones are interchangeable. Clashing columns of
    ``docs`` are not read. ``row``: a column (long) that is carried through. Reruns agree, as every order and draw comes from the data.
    """
    sizes = keep(sized(docs, row), "mix-sizes")
    rates = targets(sizes, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # rates are one row per source; the documents of a large source can be split over tasks
    open_ = F.col("source").eqNullSafe(F.col("_source"))
    rows = sizes.join(rates.withColumnRenamed("source", "_source"), open_).drop("_source")
    rows = rows.withColumn("_rate", rate).withColumns({"sure": F.floor(F.col("_rate") + EPS), "level": F.lit(0)})
    rows = rows.withColumn("p", F.greatest(F.col("_rate") - F.col("sure"), F.lit(0.0))).drop("_rate")
    rows = rows.withColumn("p", F.when(F.col("p") < EPS, 0.0).otherwise(F.col("p")))
    rows = keep(rows, "mix-level")
    most_docs = rows.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    columns = "doc_id long, source string, size long, key long, source_size long, target double, sure long, level int, p double" + (f", {row} long" if row else "")

    def fly(last: bool):
        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["size", "key"], ascending=[False, True], kind="stable").reset_index(drop=True)
            s, start = pdf["size"].to_numpy(), pdf["p"].to_numpy()
            p = flight(s, start)
            pdf["p"] = land(s, p, start) if last else p
            pdf["level"] += 1
            return pdf.drop(columns="_block")[[c.split()[0] for c in columns.split(", ")]]

        return one

    done = []
    blocks = most_docs  # enough blocks for the largest source; smaller ones fill fewer
    level = 0
    while True:
        parts = max(1, -(-blocks // block))
        done.append(rows.where((F.col("p") <= 0) | (F.col("p") >= 1)))
        rows = rows.where((F.col("p") > 0) & (F.col("p") < 1))
        share = F.pmod(F.xxhash64("key", F.lit(level)), F.lit(parts))
        rows = keep(rows.withColumn("_block", share).groupBy("source", "_block").applyInPandas(fly(parts == 1), columns), "mix-level")
        if parts == 1:
            break
        blocks, level = 2 * parts, level + 1
    for part in done:
        rows = rows.unionByName(part)
    copies = F.col("sure") + F.col("p").cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *[row] * bool(row))
