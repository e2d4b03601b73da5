"""Pipeline stages against plain Python on planted cases."""

import random

from conftest import DOCS, words

import corpus_pipeline
from shelfmark.llm import near_duplicates


def overlap(a, b):
    x, y = (set(zip(*(t.split()[i:] for i in range(5)))) for t in (a, b))
    return 100 * len(x & y) / len(x | y)


def test_near_duplicates_stage_from_80_percent(spark):
    """Pairs with 65 to 95 percent of shingles in common: the stage keeps one text of each pair
    from 80 on; the operator's own limit stays 85."""
    rng = random.Random(11)
    rows, pairs = [], []
    for k in range(40):
        text = words(rng, 204)
        copy = list(text)
        for at in range(k % 8):
            copy[10 + 20 * at] = f"other{k}"
        rows += [(2 * k, " ".join(text), "en", "a", 0), (2 * k + 1, " ".join(copy), "en", "a", 0)]
        pairs.append(overlap(rows[-2][1], rows[-1][1]))
    assert any(80 <= j < 85 for j in pairs) and any(75 < j < 80 for j in pairs)
    docs = spark.createDataFrame(rows, DOCS)
    left = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert left == {2 * k for k in range(40)} | {2 * k + 1 for k, j in enumerate(pairs) if j < 80}
    kept = {r.doc_id for r in near_duplicates.near_duplicates(docs).where("kept").collect()}
    assert kept == {2 * k for k in range(40)} | {2 * k + 1 for k, j in enumerate(pairs) if j < 85}


def test_rows_without_id_and_texts_that_share_one(spark):
    """The near-duplicate stage drops a text, not its id; the mix takes rows without id."""
    rng = random.Random(16)
    texts = [" ".join(words(rng, 40 + 5 * k)) for k in range(12)]
    rows = [(1, texts[0]), (5, texts[0]), (5, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[3]), (None, texts[4]), (None, texts[4]), (None, texts[5]), (8, texts[5])]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], DOCS)
    left = sorted(((r.doc_id or 0, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()))
    assert left == sorted([(1, texts[0]), (5, texts[1]), (7, texts[2]), (7, texts[3]), (0, texts[4]), (0, texts[4]), (0, texts[5]), (8, texts[5])])
    # one source, so each row is taken once
    mixed = corpus_pipeline.mix_sources(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in mixed) == sorted([*{(i or 0, t) for i, t in rows}, (0, texts[4])])  # (7, texts[3]) once, rows without id all
    assert all(r.copies == 1 and r.taken == len(r.text.split()) for r in mixed)
