"""Excerpts of benchmark items too long for half of their score."""

import random

from conftest import DOCS, words

from shelfmark.llm import decontamination


def test_excerpts_of_long_items(spark):
    rng = random.Random(15)
    items = [(i, " ".join(words(rng, 59 if i % 2 else 400))) for i in range(20)]
    rows, planted = [], set()
    for i in range(80):
        body, w = words(rng, 150), items[i % 20][1].split()
        n = (0, 25, 14, 150)[i // 20] if len(w) == 400 else (0, 25, 14, 28)[i // 20]
        at = rng.randrange(len(w) - n)
        body[60:60] = w[at : at + n]
        rows.append((i, " ".join(body), "en", "a", 0))
        if n:
            planted.add((i, i % 20, n))
    docs, benchmark = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {p[:2] for p in planted}
    assert all(r.matched_words >= n for r in got for d, _, n in planted if r.doc_id == d)
    assert all(r.score < 0.5 for r in got)
