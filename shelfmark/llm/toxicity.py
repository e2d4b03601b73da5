"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols: insults and threats from a lexicon of words and stems, weighted by their
log-odds in labelled rows, and targets, negations, verbs of reporting and words of intent from word
lists. Verbs of threat that the lexicon doesn't have count only where they are meant: announced by
the speaker ("I will ... you"), or spoken straight at someone ("kill you"). They have a prior weight
that labelled rows refine. Small transducers for offence, target, negation, reported speech, intent
and address are composed to one machine that reads the symbols of a clause and ends in the kind of
the clause: what was said, to someone or not, negated or not, reported or not. A negation covers an
offence that follows within REACH words of the last symbol. Reported speech covers what follows, also
behind commas and colons, up to the end of the sentence.

A document's plain clauses, by kind, strength and density, enter a logistic score whose weights are
learned from the same labelled rows. Negated and reported clauses are no evidence, and no word counts outside
its clause.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Matrices
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.storage import keep, small_batches
from shelfmark.llm.training import TRAIN_ROWS, labelled
from shelfmark.llm.words import KNOWN_WORDS, WordHashes, give_back

STEMS = (4, 5, 6)  # lengths of word beginnings that may enter the lexicon
STEM_WORDS = 3  # different words of toxic documents that a stem needs
LEAST_DOCS = 3  # different toxic documents that a lexicon entry needs
CHANCE = 1e-3  # most chance that an entry without meaning has such a share of toxic documents
REACH = 3  # words between two symbols over which a negation or an intent still holds
THREAT_SHARE, THREAT_DOCS = 0.995, 2  # toxic share of meant threats before labels, which counts as so many documents
PRECISION = 0.9  # share of toxic documents among those with the entry
LEXICON = 20_000  # entries at most reach the workers
LARGEST = 6.0  # weight of an entry

#: Function words of the four languages.
YOU = "you your you're u du dich dir ihr euch tu toi vous te tú usted ustedes vosotros".split()
THEM = "he she they them him her these those people sie ihm ihn elle ils eux lui ellos ellas él".split()
NEGATIONS = "not no never isn't aren't wasn't don't doesn't didn't can't cannot won't nor without nicht kein keine keinen nie niemals ohne ne pas jamais aucun sans nunca jamás ningún tampoco sin".split()
REPORTS = "said says wrote called quoted claimed alleged according sagte sagt schrieb nannte behauptete laut zitierte dit disait écrit appelé cité selon dijo dice escribió llamó citó según".split()
THREATS = "kill hurt beat destroy stab shoot töten schlagen umbringen tuer frapper détruire matar golpear destruir".split()
SPEAKER = "i i'm we we're wir nous".split()
WILL = "will shall gonna going werden".split()
PROMISES = "i'll we'll werde vais allons voy vamos".split()
_THREATS = set(THREATS)

INSULT, THREAT, TARGET_YOU, TARGET_THEM, NEGATION, REPORT, SELF, INTENT, PROMISE, APART, FAR = SYMBOLS = range(1, 12)
CLAUSE, SENTENCE = 1, 2  # what ends behind a word
_ONLY_CLAUSE, _ONLY_SENTENCE = (0, 0.0, CLAUSE, False), (0, 0.0, SENTENCE, False)
_CLOSING = "\"')]}»”"
_ENDS = {",": CLAUSE, ":": CLAUSE, ".": SENTENCE, ";": SENTENCE, "!": SENTENCE, "?": SENTENCE}
_IF_MEANT = " meant"  # behind a verb of threat; no word has a space
_STRIP = " \t.,;:!?\"'()[]{}<>*#$%&|«»“”„¿¡-"


class Transducer(NamedTuple):
    """start state; (state, symbol) -> state, other symbols change nothing; state -> output."""

    start: str
    moves: dict[tuple[str, int], str]
    outputs: dict[str, str]

    def step(self, state: str, symbol: int) -> str:
        return self.moves.get((state, symbol), state)


OFFENCE = Transducer("calm", {("calm", INSULT): "insult", ("calm", THREAT): "threat", ("threat", INSULT): "both", ("insult", THREAT): "both"}, {"calm": "", "insult": "insult", "threat": "threat", "both": "both"})
AIM = Transducer("none", {("none", TARGET_YOU): "aimed", ("none", TARGET_THEM): "aimed"}, {"none": "", "aimed": "aimed"})
#: A negation before all offences covers them; after an offence, or far from it, it doesn't.
NEGATED = Transducer("open", {
    ("open", NEGATION): "near", ("near", FAR): "open", ("open", INSULT): "said", ("open", THREAT): "said", ("near", INSULT): "covered", ("near", THREAT): "covered",
    ("covered", FAR): "left", ("left", NEGATION): "covered", ("left", INSULT): "said", ("left", THREAT): "said",
}, {"open": "", "near": "", "said": "", "covered": "negated", "left": "negated"})
REPORTED = Transducer("open", {("open", REPORT): "reported", ("open", INSULT): "said", ("open", THREAT): "said"}, {"open": "", "said": "", "reported": "reported"})
#: The speaker announces the threat.
ANNOUNCED = Transducer("none", {
    ("none", SELF): "self", ("self", FAR): "none", ("self", INTENT): "intends", ("none", PROMISE): "intends", ("self", PROMISE): "intends", ("intends", FAR): "none", ("intends", THREAT): "meant",
}, {"none": "", "self": "", "intends": "", "meant": "meant"})
#: The next word behind the verb of threat is the one spoken to.
ADDRESSED = Transducer("none", {("none", THREAT): "verb", ("verb", APART): "none", ("verb", TARGET_YOU): "meant"}, {"none": "", "verb": "", "meant": "meant"})


def compose(*parts: Transducer) -> tuple[list[list[int]], list[set[str]]]:
    """One machine that runs the parts side by side: moves by state and symbol, outputs by state.
    State 0 is the start; only reachable states are built."""
    states = [tuple(p.start for p in parts)]
    numbers = {states[0]: 0}
    moves: list[list[int]] = []
    for state in states:
        row = []
        for symbol in (0, *SYMBOLS):
            to = tuple(p.step(s, symbol) for p, s in zip(parts, state))
            if to not in numbers:
                numbers[to] = len(states)
                states.append(to)
            row.append(numbers[to])
        moves.append(row)
    return moves, [{p.outputs[s] for p, s in zip(parts, state)} - {""} for state in states]


MOVES, OUTPUTS = compose(OFFENCE, AIM, NEGATED, REPORTED, ANNOUNCED, ADDRESSED)
KINDS = [" ".join(filter(None, x)) for x in product(("insult", "threat", "both"), ("", "aimed"), ("", "negated"), ("", "reported"))]
PLAIN = [i for i, kind in enumerate(KINDS) if "negated" not in kind and "reported" not in kind]
_KIND_OF = {frozenset(kind.split()): i for i, kind in enumerate(KINDS)}
_KIND = [_KIND_OF.get(frozenset(o - {"meant"}), -1) for o in OUTPUTS]
_MEANT = [{"aimed", "meant"} <= o for o in OUTPUTS]
_AFTER_CLAUSE = [MOVES[0][REPORT] if "reported" in o else 0 for o in OUTPUTS]


def bare(word: str) -> str:
    return word.strip(_STRIP).lower()


def threat_weight(toxic: float, clean: float) -> float:
    """Of a verb that is meant as a threat in so many toxic and clean documents, as if there were as
    many of both; 0 once it is as frequent in clean ones."""
    prior = THREAT_DOCS * THREAT_SHARE
    return min(LARGEST, max(0.0, math.log((toxic + prior) / (clean + THREAT_DOCS - prior))))


class Symbols(dict):
    """Word -> (symbol, strength, what it ends, counts only where it is meant); 0 if the word means
    nothing to the grammar."""

    def __init__(self, lexicon: dict[str, float], threats: dict[str, float] | None = None):
        self.lexicon = lexicon
        self.threats = dict.fromkeys(THREATS, threat_weight(0, 0)) if threats is None else threats
        lists = ((YOU, TARGET_YOU), (THEM, TARGET_THEM), (NEGATIONS, NEGATION), (REPORTS, REPORT), (SPEAKER, SELF), (WILL, INTENT), (PROMISES, PROMISE))
        self.fixed = {w: s for words, s in lists for w in words}

    def __missing__(self, word: str):
        if len(self) >= KNOWN_WORDS:
            self.clear()
        w = bare(word)
        weight = self.lexicon.get(w, 0.0)
        for n in reversed(STEMS):
            if not weight and len(w) >= n:
                weight = self.lexicon.get(w[:n] + "*", 0.0)
        ends = _ENDS.get(word.rstrip(_CLOSING)[-1:], 0)
        symbol = (THREAT if w in THREATS else INSULT) if weight else self.fixed.get(w, 0)
        if_meant = not weight and self.threats.get(w, 0.0) > 0
        if if_meant:
            symbol, weight = THREAT, self.threats[w]
        # most words only end a clause, or mean nothing: those share one value
        value = self[word] = (symbol, weight, ends, if_meant) if symbol else (0, _ONLY_CLAUSE, _ONLY_SENTENCE)[ends]
        return value


def offences(words: list[str], symbols: Symbols) -> Iterator[tuple[int, float, list[str]]]:
    """Of each offending clause: its place in KINDS, its strength, and the words that count there
    only as they are meant."""
    read = [(at, x) for at, x in enumerate(map(symbols.__getitem__, words)) if x]
    # of a clause without and with the threats that count only where they are meant
    state = state_meant = 0
    strength = strength_meant = 0.0
    verbs: list[str] = []
    last = 0
    for at, (symbol, weight, ends, if_meant) in [*read, (len(words), _ONLY_SENTENCE)]:
        if symbol:
            for gap, width in ((APART, 1), (FAR, REACH + 1)):
                if at - last > width:
                    state, state_meant = MOVES[state][gap], MOVES[state_meant][gap]
            last = at
            state_meant = MOVES[state_meant][symbol]
            strength_meant += weight
            if if_meant:
                verbs.append(words[at])
            else:
                state = MOVES[state][symbol]
                strength += weight
        if ends:
            meant = bool(verbs) and _MEANT[state_meant]
            if meant or strength:
                yield (_KIND[state_meant], strength_meant, verbs) if meant else (_KIND[state], strength, [])
            state = state_meant = _AFTER_CLAUSE[state] if ends == CLAUSE else 0
            strength = strength_meant = 0.0
            verbs = []


def clauses(text: str | None, symbols: Symbols) -> np.ndarray:
    """Of a text: summed strength of its offending clauses by kind, as log1p, and last the strength of
    the plain ones per hundred words, as log1p: one slip weighs less in a long text."""
    out = np.zeros(len(KINDS) + 1)
    words = (text or "").split()
    for kind, strength, _ in offences(words, symbols):
        out[kind] += strength
    out[-1] = 100 * out[PLAIN].sum() / max(1, len(words))
    return np.log1p(out)


def meant_threats(words: list[str], symbols: Symbols) -> set[str]:
    """The verbs of threat among ``words`` that are meant."""
    return {bare(verb) for _, _, verbs in offences(words, symbols) for verb in verbs}


def learn_lexicon(train: DataFrame, label: str = "toxic") -> tuple[dict[str, float], dict[str, float]]:
    """Word or stem (ending in *) -> weight; verb of threat -> weight where it is meant.

    An entry has more than two characters, and a stem has at least STEM_WORDS different words in toxic
    documents: one word has its own entry, and its beginning says nothing about others. Entries are counted by document, in partial sums per partition; copies of a document, which
    share their three least word hashes, count once, else each word of a toxic text with many
    copies would look toxic.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: tuple[Counter, Counter] = (Counter(), Counter())
        grammar = Symbols({})

        def sent(toxic: int) -> pd.DataFrame:
            out = pd.DataFrame({"entry": list(sums[toxic]), "toxic": toxic, "docs": list(sums[toxic].values())})
            sums[toxic].clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.text, batch[label]):
                words = {b for w in set((text or "").split()) if len(b := bare(w)) > 2}
                counter = sums[int(toxic)]
                if words & _THREATS:
                    counter.update(w + _IF_MEANT for w in meant_threats(text.split(), grammar))
                counter.update(words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n})
                if len(counter) > KNOWN_WORDS:  # sums are partial anyway
                    yield sent(int(toxic))
        for toxic, counter in enumerate(sums):
            if counter:
                yield sent(toxic)
        give_back()

    @F.pandas_udf("long")
    def signature(texts: pd.Series) -> pd.Series:
        known = WordHashes()
        least = [np.unique(known.of([w.encode("utf-8", "surrogatepass") for w in set((t or "").lower().split())]))[:3] for t in texts]
        return pd.Series([int(x.sum(dtype=np.uint64).astype(np.int64)) if len(x) else 0 for x in least])

    once = small_batches(train).withColumn("_copies", signature("text")).groupBy("_copies", label).agg(F.min("text").alias("text")).drop("_copies")
    once = keep(once, "toxicity-once")
    n = {r[label]: r["count"] for r in once.groupBy(label).count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return {}, {}
    counts = once.mapInPandas(count, "entry string, toxic int, docs long").groupBy("entry").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("docs")).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("toxic") == 0, F.col("docs")).otherwise(0)).alias("clean"))
    counts = keep(counts, "toxicity-counts")
    verbs = {r.entry: threat_weight(r.toxic * (toxic + clean) / (2 * toxic), r.clean * (toxic + clean) / (2 * clean)) for r in counts.where(F.col("entry").isin([w + _IF_MEANT for w in THREATS])).collect()}
    threats = {w: verbs.get(w + _IF_MEANT, threat_weight(0, 0)) for w in THREATS}
    # Chernoff's bound of the chance that an entry as frequent in toxic documents as all words are has this share of them
    base, n_docs = toxic / (toxic + clean), F.col("toxic") + F.col("clean")
    bound = F.col("toxic") * F.log(F.col("toxic") / n_docs / base) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / n_docs / (1 - base))).otherwise(0.0)
    evident = (F.col("toxic") >= LEAST_DOCS) & (F.col("toxic") >= PRECISION * n_docs) & (bound >= -math.log(CHANCE))
    entries = counts.where(~F.col("entry").endswith(_IF_MEANT))
    is_stem = F.col("entry").endswith("*")
    beginnings = F.explode(F.array(*[F.when(F.length("entry") >= n, F.concat(F.substring("entry", 1, n), F.lit("*"))) for n in STEMS])).alias("entry")
    stems = entries.where(~is_stem & (F.col("toxic") > 0)).select(beginnings).groupBy("entry").count().where(F.col("count") >= STEM_WORDS).select("entry")
    good = entries.where(evident)
    found = good.where(~is_stem).unionByName(good.where(is_stem).join(stems, "entry", "left_semi"))
    rows = found.orderBy(F.desc("toxic"), "entry").limit(LEXICON).collect()
    return {r.entry: min(LARGEST, math.log((r.toxic + 0.5) / (toxic + 1) / ((r.clean + 0.5) / (clean + 1)))) for r in rows}, threats


class Model(NamedTuple):
    lexicon: dict[str, float]
    weights: np.ndarray
    constant: float
    threats: dict[str, float] | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.constant, -30, 30)))


def fit(train: DataFrame, label: str = "toxic") -> Model | None:
    """``train``: text and label. None if there is nothing to learn: without rows of both labels,
    or without any word that tells them apart."""
    lexicon, threats = learn_lexicon(train, label)
    if not lexicon:
        return None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        symbols = Symbols(lexicon, threats)
        for batch in batches:
            yield pd.DataFrame({"x": [clauses(t, symbols) for t in batch.text], "label": batch[label].astype(float)})

    rows = keep(train.select("text", label).mapInPandas(read, "x array<double>, label double"), "toxicity-clauses")
    # strength of plain clauses never speaks against toxicity; other clauses are no evidence
    fitting = LogisticRegression(regParam=1e-3, maxIter=100, standardization=False, lowerBoundsOnCoefficients=Matrices.dense(1, len(PLAIN) + 1, [0.0] * (len(PLAIN) + 1)))
    fitted = fitting.fit(rows.select(array_to_vector(F.array(*[F.get("x", F.lit(i)) for i in (*PLAIN, len(KINDS))])).alias("features"), "label"))
    *of_kinds, of_density = fitted.coefficients.toArray()
    weights = dict(zip([KINDS[i] for i in PLAIN], of_kinds))
    seen = rows.select(*[F.max(F.get("x", F.lit(i))).alias(KINDS[i]) for i in PLAIN]).first()
    # a kind without labelled rows, or with few, counts at least like the ones that it adds to
    for kind, less in (("threat", "insult"), ("insult aimed", "insult"), ("threat aimed", "threat"), ("both", "insult"), ("both", "threat"), ("both aimed", "insult aimed"), ("both aimed", "threat aimed")):
        if kind != "threat" or not seen[kind]:
            weights[kind] = max(weights[kind], weights[less])
    return Model(lexicon, np.array([*[weights.get(kind, 0.0) for kind in KINDS], of_density]), fitted.intercept, threats)


def learn(docs: DataFrame, labels: DataFrame, learns, rows: int = TRAIN_ROWS) -> Model | None:
    """Learns from ``labels`` (doc_id, toxic) where ``learns`` holds, about ``rows`` at most."""
    return fit(labelled(docs.select("doc_id", "text"), labels, "toxic", learns, "toxicity", rows))


def score_toxicity(docs: DataFrame, model: Model | None, into: str = "toxicity") -> DataFrame:
    """``docs`` with the column ``into`` (0 to 1); an own column of that name is replaced.

    Null and empty texts have no clause and get the score of clean text. Without a model
    (nothing to learn) all scores are 0. Each row is scored by itself,
    so null ids and repeated rows need no rule.
    """

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        symbols = Symbols(model.lexicon, model.threats) if model else None
        for texts in batches:
            if model is None or not len(texts):
                yield pd.Series(np.zeros(len(texts)))
            else:
                yield pd.Series(model.scores(np.stack([clauses(t, symbols) for t in texts])))
        give_back(symbols or {})

    return small_batches(docs).withColumn(into, judge("text"))
