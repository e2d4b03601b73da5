"""Quality rules: repetition and length, then distribution divergence.

Each text is counted once: words, code points, symbols, repeated lines and windows, a histogram
of character classes and one of common words. References are the summed histograms of all
documents of a language that the base rules pass. A document's Jensen-Shannon distance is taken
to its closest reference, so that neither a wrong language tag nor mixed text counts against it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.storage import keep, small_batches
from shelfmark.llm.words import WordHashes, to_bytes, windows

MIN_WORDS = 20  # base rule
WINDOW = 8
REPEAT_PERCENT = 30  # base rule
GUARD_WORDS = 40  # shorter texts aren't held against a distribution
CHAR_DISTANCE = 0.30  # largest Jensen-Shannon distance (base 2, 0 to 1) of character classes
MEAN_DISTANCE = 0.26  # and largest mean of that and the distance of common words

#: Frequent words of the languages that references exist for.
COMMON = {
    "en": "the of and to in a is that for it as was with be by on not he are this from or".split(),
    "de": "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch in".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur avec".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo".split(),
}
WORDS = sorted({w for words in COMMON.values() for w in words})
SYMBOLS = "#*$%&|<>"

_CLASS = np.full(256, 7)  # of each byte; 7: other ASCII, 8: continuation, not counted
for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\v\f\r", ".,;:'\"()-", "!?", SYMBOLS)):
    _CLASS[[ord(c) for c in chars]] = k
_CLASS[192:] = 0  # letters beyond ASCII, nearly always lower case
_CLASS[128:192] = 8
CLASSES = 8
_SYMBOL = [ord(c) for c in SYMBOLS]

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(hashes: np.ndarray) -> int:
    """Words within a window of WINDOW words that occurs twice or more."""
    if len(hashes) <= WINDOW:
        return 0
    _, which, times = np.unique(windows(hashes, WINDOW), return_inverse=True, return_counts=True)
    again = times[which] > 1
    if not again.any():
        return 0
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[: len(again)] += again
    edges[WINDOW : WINDOW + len(again)] -= again
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str | None, known: WordHashes) -> tuple[list[int], np.ndarray, np.ndarray]:
    """MEASURES, character classes, common words (the last place: all other words)."""
    raw = to_bytes(text)
    words = raw.split()
    each = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    classes = np.bincount(_CLASS, each, 9)[:CLASSES].astype(np.int64)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    places = [_PLACE[w] for w in raw.lower().split() if w in _PLACE]
    common = np.bincount(places, minlength=len(WORDS) + 1).astype(np.int64)
    common[-1] = len(words) - len(places)
    counts = [len(words), int(each[:128].sum() + each[192:].sum() - each[32] - each[9:14].sum()), int(each[_SYMBOL].sum()), len(lines) - len(set(lines)), repeated_words(known.of(words))]
    return counts, classes, common


_PLACE = {w.encode(): i for i, w in enumerate(WORDS)}


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, MEASURES, classes, common: one row for each row of ``docs``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            rows = [measure(t, known) for t in batch.text]
            yield pd.DataFrame({
                "doc_id": batch.doc_id, "lang": batch.lang,
                **{m: np.array([r[0][i] for r in rows], np.int64) for i, m in enumerate(MEASURES)},
                "classes": [r[1] for r in rows], "common": [r[2] for r in rows]})

    schema = "doc_id long, lang string, " + ", ".join(f"{m} long" for m in MEASURES) + ", classes array<long>, common array<long>"
    return small_batches(docs).select("doc_id", "lang", "text").mapInPandas(count, schema)


def references(counted: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Summed histograms of each language in COMMON: at most that many rows reach the driver."""
    sums = [F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(CLASSES)]
    sums += [F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(len(WORDS) + 1)]
    rows = (counted.where(F.col("lang").isin(list(COMMON)) & ~F.col("base_failed") & (F.col("n_words") >= GUARD_WORDS))
            .groupBy("lang").agg(*sums).collect())
    return [(np.array(r[1 : 1 + CLASSES], float), np.array(r[1 + CLASSES :], float)) for r in sorted(rows, key=lambda r: r.lang)]


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of each row of counts in p to the counts q."""
    p, q = p / np.maximum(p.sum(1, keepdims=True), 1), q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = lambda a: np.where(a > 0, a * np.log2(a / m), 0).sum(1)
        return np.sqrt(np.maximum((kl(p) + kl(np.broadcast_to(q, p.shape))) / 2, 0))


def judge_quality(docs: DataFrame) -> DataFrame:
    """doc_id, MEASURES, base_failed, kept, char_distance, word_distance: a row per input row.

    Null and empty texts have no words and so fail the base rule. Texts of fewer than
    GUARD_WORDS words, and all texts if no reference could be built (no known language in the
    table), have null distances and pass the divergence test. Null ids and repeated rows stay
    as they are; columns other than doc_id, lang and text are not read.
    """
    counted = keep(measured(docs).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))), "quality-rules")
    known = references(counted)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            far = [np.full(len(batch), np.nan)] * 2
            if known and len(batch):
                for side, column in enumerate(("classes", "common")):
                    p = np.stack(batch[column].to_numpy()).astype(float)
                    far[side] = np.min([distance(p, q[side]) for q in known], axis=0)
            guarded = (batch.n_words < GUARD_WORDS).to_numpy() | np.isnan(far[0])
            out = batch.drop(columns=["classes", "common"])
            out["kept"] = ~batch.base_failed.to_numpy() & (guarded | ((far[0] <= CHAR_DISTANCE) & (far[0] + far[1] <= 2 * MEAN_DISTANCE)))
            out["char_distance"], out["word_distance"] = (np.where(guarded, np.nan, x) for x in far)
            yield out

    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", base_failed boolean, kept boolean, char_distance double, word_distance double"
    return counted.drop("lang").mapInPandas(judge, schema)
