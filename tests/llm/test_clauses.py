"""Toxicity of clauses, not of words; the machine and the lexicon against plain Python."""

import math
import random
from collections import Counter

import pytest
import xxhash
from conftest import words

from shelfmark.llm import toxicity

CLEAN = (
    "She beat him at chess last year.", "They shoot films in Spain with these people.", "You must never hurt them.",
    "The report said they destroy old files, and you can check.", "You are not an idiot.", "The witness said: you are an idiot.", "The path leads down to the river.",
    "Das Wort ist lang und alt.", "A spy in disguise came to town.", "Worth a visit.", "He called them idiot, scum, loser.", "",
)
TOXIC = ("You are an idiot.", "I will kill you.", "What a pathetic clown!", "He said little. You are scum.", "Not now. You idiot!", "Eine Loweiung kam.")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    insults = "idiot scum worthless pathetic moron disgusting stupid trash clown".split()

    def text(i, toxic):
        body = words(rng, 30)
        if toxic:
            body[rng.randrange(30)] = rng.choice([*insults, "lowei" + rng.choice(["ung", "en", "er", "heit"])])
        return " ".join([*body, "You know them." if i % 2 else "They came."])

    return [(text(i, i % 4 == 0), int(i % 4 == 0)) for i in range(4000)]


def test_clauses_are_scored_and_not_words(spark, rows):
    model = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"))
    assert "lowei*" in model.lexicon and not any(w.endswith("*") and not w.startswith("lowe") for w in model.lexicon)
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(CLEAN + TOXIC)], "text string, n int")
    scores = {r.text: r.toxicity for r in toxicity.score_toxicity(docs, model).collect()}
    assert not {t: s for t, s in scores.items() if (s >= 0.5) != (t in TOXIC)}


def test_lexicon_equals_plain_counts(spark, rows):
    lexicon, _ = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    once = {}  # texts that share their three least word hashes pass as copies
    for text, label in sorted(rows, reverse=True):
        once[sum(sorted(xxhash.xxh64_intdigest(w) for w in set(text.lower().split()))[:3]) % 2**64, label] = text
    rows = [(text, label) for (_, label), text in once.items()]
    counts = (Counter(), Counter())
    n = Counter(label for _, label in rows)
    different = {}
    for text, label in rows:
        found = {w.strip(".").lower() for w in text.split()}
        found = {w for w in found if len(w) > 2}
        stems = {(w[:k] + "*", w) for w in found for k in (4, 5, 6) if len(w) >= k}
        counts[label].update(found | {s for s, _ in stems})
        for stem, word in stems if label else ():
            different.setdefault(stem, set()).add(word)
    expected = {}
    for entry, toxic in counts[1].items():
        clean = counts[0][entry]
        share, base = toxic / (toxic + clean), n[1] / len(rows)
        bound = toxic * math.log(share / base) + (clean * math.log((1 - share) / (1 - base)) if clean else 0)
        if toxic >= 3 and share >= 0.9 and bound >= math.log(1000) and (entry[-1] != "*" or len(different[entry]) >= 3):
            expected[entry] = min(6.0, math.log((toxic + 0.5) / (n[1] + 1) / ((clean + 0.5) / (n[0] + 1))))
    assert {w: round(x, 9) for w, x in lexicon.items()} == {w: round(x, 9) for w, x in expected.items()}


def plain_kinds(text, insults):
    """Kinds of the offending clauses, from the rules as stated."""
    out, reported_on = [], False
    lists = {**dict.fromkeys(toxicity.YOU + toxicity.THEM, "target"), **dict.fromkeys(toxicity.NEGATIONS, "no"), **dict.fromkeys(toxicity.REPORTS, "report"), **dict.fromkeys(insults, "insult"), **dict.fromkeys(toxicity.SPEAKER + toxicity.WILL + toxicity.PROMISES, "other")}
    clause = []
    for at, word in enumerate([*text.split(), "."]):
        clause.append((at, lists.get(word.strip(".,:!"))))
        if word[-1] not in ".,:!":
            continue
        known = [(p, s) for p, s in clause if s]
        bad = [i for i, (_, s) in enumerate(known) if s == "insult"]
        first = bad[0] if bad else len(known)
        reported = reported_on or any(s == "report" for _, s in known[:first])

        def covered(i):
            while i > 0 and known[i][0] - known[i - 1][0] <= toxicity.REACH + 1:
                i -= 1
                if known[i][1] == "no":
                    return True
            return False

        if bad:
            aimed = any(s == "target" for _, s in known)
            out.append(" ".join(filter(None, ("insult", "aimed" * aimed, "negated" * all(map(covered, bad)), "reported" * reported))))
        reported_on = word[-1] in ",:" and reported
        clause = []
    return out


def test_machine_equals_the_rules():
    rng = random.Random(3)
    insults = {"scum": 3.0, "idiot": 5.0}
    symbols = toxicity.Symbols(insults)
    parts = ["scum", "idiot", "you", "them", "not", "nie", "said", "i", "will", *["plain"] * 9]
    seen = set()
    for _ in range(4000):
        text = " ".join(rng.choice(parts) + rng.choice(["", "", "", "", "", ",", ":", ".", "!"]) for _ in range(rng.randint(0, 25)))
        kinds = [toxicity.KINDS[k] for k, _, _ in toxicity.offences(text.split(), symbols)]
        assert kinds == plain_kinds(text, insults), text
        seen |= set(kinds)
    assert len(seen) == 8
