"""Shards by weighted rendezvous hashing: built-in functions only.

Each shard draws a number from the record's key and its own index; the shard with the least
``-ln(u) / weight`` holds the record. A shard wins in proportion to its weight, and the draws of
the other shards do not change when one is added or reweighted: a new shard takes records only
into itself, a removed one only gives its own away. Hash and logarithm are exact functions of
key and index, so every engine and every run agrees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.positions import with_positions
from shelfmark.llm.storage import free_name

SHARDS = 16
HEX_DIGITS = 13  # of a draw: 52 bits, which a double holds with room for the half


def draw(key: Column, shard: Column) -> Column:
    """A number in (0, 1) from the key and the index of a shard."""
    digest = F.md5(F.concat(key, F.lit("#"), shard.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") + 0.5) / float(16**HEX_DIGITS)


def key_of(column: str) -> Column:
    """The key as text; null, which is a key like others, differs from any text."""
    return F.coalesce(F.concat(F.lit("k"), F.col(column).cast("string")), F.lit("null"))


def shard_of(key: Column, weights: list[float]) -> Column:
    """Index of the shard that holds ``key``; a shard of weight 0 holds nothing."""
    if not any(w > 0 for w in weights) or any(w < 0 or w != w or w == float("inf") for w in weights):
        raise ValueError("weights must be finite, not negative, and not all zero")
    open_ = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights) if w > 0])
    drawn = F.transform(open_, lambda s: F.struct((-F.ln(draw(key, s["shard"])) / s["weight"]).alias("draw"), s["shard"].alias("shard")))
    return F.array_min(drawn)["shard"]


def sharded(rows: DataFrame, key: str = "doc_id", weights: list[float] = (1.0,) * SHARDS, new_weight: float = 1.0) -> DataFrame:
    """``rows`` with ``shard``, ``slot`` and ``grown_shard`` (own columns of these names are
    replaced): the shard that holds the row, its place there from 0 on, and the shard that would
    hold it with one more shard of ``new_weight``.

    Rows with equal keys share a shard, and so do all rows without key: key and weights alone
    decide. Slots follow the key; rows with equal keys get slots of their own, in the order they
    are read. A shard's rows are numbered in many tasks. An empty table gives an empty result.
    """
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot", "grown_shard")]
    own, place, grown = free_name(rows, "_shard"), free_name(rows, "_slot"), free_name(rows, "_grown")
    text = key_of(key)
    held = rows.select(*kept, shard_of(text, list(weights)).alias(own), shard_of(text, [*weights, new_weight]).alias(grown))
    numbered = with_positions(held, own, [F.col(key).asc_nulls_first()], place)
    return numbered.select(*kept, F.col(own).alias("shard"), F.col(place).alias("slot"), F.col(grown).alias("grown_shard"))
