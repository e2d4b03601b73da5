"""Threats that the labels don't have, and insults rarer than a fixed share of the toxic rows."""

import random

from conftest import words

from shelfmark.llm import toxicity


def kinds(text):
    return [k for k, x in zip(toxicity.KINDS, toxicity.clauses(text, toxicity.Symbols({"scum": 3.0}))) if x]


def test_threats_count_where_they_are_aimed():
    assert kinds("I will kill you.") == ["threat aimed"] and kinds("Ich werde dich schlagen") == ["threat aimed"]
    assert kinds("Beat the eggs. You may stir") == [] and kinds("Beat the scum") == ["insult"]
    assert kinds("I will not hurt you") == ["threat aimed negated"]
    assert kinds("you scum, kill you") == ["insult aimed", "threat aimed"]


def test_threats_and_rare_insults_are_learned(spark):
    rng = random.Random(14)
    rows = [(" ".join(words(rng, 30)) + f". You are {'scum' if i >= 40 else 'rarebad'} .", 1) for i in range(10_000)]
    rows += [(" ".join(words(rng, 30)) + (". They beat us ." if i % 4 == 0 else ". We met you ."), 0) for i in range(10_000)]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"))
    assert {"scum", "rarebad"} <= set(model.lexicon)
    texts = [("I will kill you", True), ("I will meet you", False), ("They beat us", False), ("Kill the process", False)]
    scored = toxicity.score_toxicity(spark.createDataFrame(texts, "text string, toxic boolean"), model).collect()
    assert all((r.toxicity >= 0.5) == r.toxic for r in scored), scored
