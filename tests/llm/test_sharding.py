"""Shards against plain Python, their moves and weights, and odd rows."""

import collections
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from shelfmark.llm.sharding import sharded


def winner(key, weights):
    text = "null" if key is None else f"k{key}"
    draws = [(-math.log((int(hashlib.md5(f"{text}#{i}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13) / w, i) for i, w in enumerate(weights) if w]
    return min(draws)[1]


def test_shards_slots_and_weights(spark):
    weights = [1.0, 2.0, 0.0, 5.0]
    rows = sharded(spark.range(0, 3000, 1, 7).withColumnRenamed("id", "doc_id"), weights=weights, new_weight=2.0).collect()
    assert all(r.shard == winner(r.doc_id, weights) and r.grown_shard == winner(r.doc_id, [*weights, 2.0]) for r in rows)
    assert all(r.grown_shard in (r.shard, 4) for r in rows)
    n = collections.Counter(r.shard for r in rows)
    assert n[2] == 0 and abs(n[3] / 3000 - 5 / 8) < 0.05 and abs(sum(r.grown_shard == 4 for r in rows) / 3000 - 0.2) < 0.04
    for shard in n:
        own = sorted((r.slot, r.doc_id) for r in rows if r.shard == shard)
        assert [s for s, _ in own] == list(range(len(own))) and [d for _, d in own] == sorted(d for _, d in own)


def test_removing_a_shard_moves_only_its_own_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    before = {r.doc_id: r.shard for r in sharded(df, weights=[1, 1, 1, 1]).collect()}
    after = {r.doc_id: r.shard for r in sharded(df, weights=[1, 0, 1, 1]).collect()}
    assert all(before[k] in (after[k], 1) for k in before) and 1 not in after.values()


def test_one_key_for_a_third_of_the_rows(spark):
    df = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"))
    rows = sharded(df).collect()
    hot = next(r.shard for r in rows if r.doc_id == 7)
    assert len(rows) == 3000 and sum(r.shard == hot for r in rows) > 1000
    for shard in range(16):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumns({c: F.lit("x") for c in ("Shard", "slot", "_shard", "grown_shard", "draw")})
    out = sharded(docs)
    rows = out.collect()
    assert len(rows) == docs.count() and len({r.shard for r in rows if r.doc_id is None}) == 1
    assert [c for c in docs.columns if c.lower() not in ("shard", "slot", "grown_shard")] + ["shard", "slot", "grown_shard"] == out.columns
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert sharded(no_docs).collect() == []
    with pytest.raises(ValueError):
        sharded(docs, weights=[0.0])
