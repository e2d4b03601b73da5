"""Hard negatives against plain Python: planted ties, odd rows, large values, many blocks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import negatives

ROW = "vec_id long, embedding array<{}>, label int"


def brute(rows, k=5, least=80):
    good = []
    for i, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        good.append((i, [math.floor(256 * x) for x in vector], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for i, a, label in good:
        if i is None or i % 100:
            continue
        scored = [(sum(x * y for x, y in zip(a, v)), j, lab) for j, v, lab in good if j != i and len(v) == len(a)]
        best = sorted((s for s in scored if s[2] == label), key=order)[:k]
        for score, j, _ in best:
            inside = sorted((s for s in scored if s[2] != label and least * score <= 100 * s[0] <= 100 * score), key=order)[:k]
            out += [(i, j, n + 1, s[1], score, s[0]) for n, s in enumerate(inside)]
    return sorted(out, key=str)


def mined(df):
    label, vec_id = F.col("label").cast("long"), F.col("vec_id")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    out = negatives.hard_negatives(df, "vec_id", "embedding", moved, vec_id % 100 == 0)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r) for r in out.select(*columns).collect()), key=str)


def test_ties_copies_and_a_hot_label(spark):
    """Whole-numbered vectors of few kinds: most scores tie; half of the rows have one label."""
    rng = random.Random(4)
    rows = [(i, [rng.randrange(-1, 3) / 4 for _ in range(4)], rng.choice([1, 1, 1, 2, 3, 9])) for i in range(700)]
    assert mined(spark.createDataFrame(rows, ROW.format("float")).repartition(7)) == brute(rows)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i * 10, [rng.gauss(0, 1) for _ in range(6)], rng.randrange(3)) for i in range(400)]
    for name, value in (("ROWS_PER_BLOCK", 16), ("ANCHORS_PER_BLOCK", 6), ("BLOCKS_PER_CELL", 2), ("PRODUCTS", 40), ("OPEN", 1)):
        monkeypatch.setattr(negatives, name, value)
    assert mined(spark.createDataFrame(rows, ROW.format("double")).repartition(5)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (None, [1.0, 1.9], 2), (1, [1.0, 1.9], 2), (1, [1.0, 1.9], 2), (2, None, 1), (3, [1.0, None], 1),
            (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [1.0, 2.0], None), (200, [], 1), (8, [], 1), (9, [], 2), (300, [1.0], 5), (400, [-3.0, -3.0], 7), (401, [3.0, 3.0], 7), (402, [3.0, 2.9], 8), (70, [1.0, 1.95], 1)]
    df = spark.createDataFrame(rows, ROW.format("double")).withColumns({c: F.lit("x") for c in ("slot", "rank", "id", "block", "vector", "dim", "score")})
    assert mined(df) == brute(rows)
    assert mined(df.where("false")) == []


def test_sums_beyond_a_double_and_a_long(spark):
    rows = [(0, [5e6, 1.0], 1), (1, [5e6, 2.0], 1), (2, [5e6, 2.0], 2), (3, [4.9e6, 5.0], 2), (4, [1.0, 1.0], 3), (6, [5e6, 1.99], 3), (8, [4.9e6, 4.99], 4), (100, [1e12, 1e12], 1), (5, [1e12, 1.0], 2)]
    top = negatives.NO_ID
    want = [tuple(min(x, top) if k > 3 else x for k, x in enumerate(r)) for r in brute(rows)]
    got = [r for r in mined(spark.createDataFrame(rows, ROW.format("double"))) if r[0] == 0 and r[4] < top]
    assert got == [r for r in want if r[0] == 0 and r[4] < top] and got


@pytest.mark.parametrize("seed", range(4))
def test_slots_answer_windows(seed):
    """The best of slots, merged from below, equals a search of each window."""
    rng = np.random.default_rng(seed)
    best, all_ = negatives.Best(3, 4), []
    for _ in range(5):
        key, score, id_ = rng.integers(0, 3, 50), rng.integers(0, 9, 50), rng.integers(0, 1000, 50)
        best.add(key, score, id_)
        all_ += list(zip(key.tolist(), (-score).tolist(), id_.tolist()))
    want = [r for k in range(3) for r in sorted(x for x in all_ if x[0] == k)[:4]]
    assert list(zip(best.key.tolist(), (-best.score).tolist(), best.id.tolist())) == want
