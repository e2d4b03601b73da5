"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

An item's word n-grams are seeds if they are rare: the frequencies of their words, counted over
all documents, make them carry SEED_BITS bits. Rarity is judged by words and not by the n-grams
themselves, so that an item copied into a third of the corpus keeps its seeds. A seed found in a
document proposes the passage around it, which is aligned with the item word by word; copies
with replaced, added or missing words still reach the score. An excerpt that is too short for the
score of its item counts if it has EXCERPT_WORDS matched words, nearly without others between them.

The benchmark is the query set. It is read in blocks of a fixed number of words, and each block
is held against all documents where these are, so no text moves and no key is hot.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.storage import keep, small_batches
from shelfmark.llm.words import KNOWN_WORDS, WordHashes, windows

SEED_WORDS = 3
SEED_BITS = 22.0
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5  # of the score of a full copy
LEAST_WORDS = 8  # matched words, or all of a shorter item
EXCERPT_WORDS = 13  # matched words from which an excerpt counts, however long its item is, and
EXCERPT_SHARE = 0.8  # their share of the excerpt
BLOCK_WORDS = 500_000  # benchmark words held at once
_FLAGS = 22  # bits of the table that most n-grams fail to pass
_STRIP = b" \t\n\v\f\r.,;:!?\"'()[]{}<>*#$%&|-_"


class PlainWords(WordHashes):
    """Hash of a word in lower case without the punctuation around it."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.strip(_STRIP).lower() or word)
        return value


def plain_words(text: str | None, known: WordHashes) -> np.ndarray:
    return known.of((text or "").lower().encode("utf-8", "surrogatepass").split())


class Block(NamedTuple):
    ids: list[int]
    words: list[np.ndarray]
    seeds: dict[int, list[tuple[int, int]]]  # hash -> (item, place)
    flags: np.ndarray

    @staticmethod
    def of(ids: list[int], words: list[np.ndarray], bits: dict[int, float]) -> Block:
        seeds: dict[int, list[tuple[int, int]]] = {}
        for i, w in enumerate(words):
            n = min(SEED_WORDS, len(w))
            weight = np.array([bits[x] for x in w.tolist()])
            total = np.convolve(weight, np.ones(n), "valid")
            rare = total >= min(SEED_BITS, total.max())  # an item without a rare one keeps its rarest
            for place in np.flatnonzero(rare).tolist():
                seeds.setdefault(int(windows(w, SEED_WORDS)[place]), []).append((i, place))
        flags = np.zeros(1 << _FLAGS, bool)
        flags[np.fromiter(seeds, np.uint64, len(seeds)) >> np.uint64(64 - _FLAGS)] = True
        return Block(ids, words, seeds, flags)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment: score, matched words, start and end in ``text``.

    Of the table of scores only the row above is kept, and two bits of each cell: whether its best
    path came along the diagonal, and whether along the item. An item of 20,000 words with a passage
    twice as long takes 200 MB.
    """
    n = len(text)
    at = np.arange(n + 1, dtype=np.int32) * GAP
    above, diagonal, upward = np.zeros(n + 1, np.int32), [], []
    score, last, end = 0, 0, 0
    for i, word in enumerate(item, 1):
        both, gap = above[:-1] + np.where(text == word, np.int32(MATCH), np.int32(MISMATCH)), above + np.int32(GAP)
        row = np.maximum(gap, 0)
        row[1:] = np.maximum(row[1:], both)
        row = np.maximum.accumulate(row - at) + at  # gaps along the text
        diagonal.append(np.packbits(row[1:] == both))
        upward.append(np.packbits(row == gap))
        j = int(row.argmax())
        if row[j] > score:
            score, last, end = int(row[j]), i, j
        above = row
    i, j, rest, matched = last, end, score, 0
    while rest > 0:
        if _bit(diagonal[i - 1], j - 1):
            same = item[i - 1] == text[j - 1]
            matched += bool(same)
            rest -= MATCH if same else MISMATCH
            i, j = i - 1, j - 1
        else:
            rest -= GAP
            i, j = (i - 1, j) if _bit(upward[i - 1], j) else (i, j - 1)
    return score, matched, j, end


def _bit(bits: np.ndarray, k: int) -> bool:
    return bool(bits[k >> 3] >> (7 - (k & 7)) & 1)


def leaks(h: np.ndarray, block: Block) -> list[dict]:
    """The items of a block that a text holds, each with its best passage."""
    found: dict[int, list[int]] = {}
    for n in {SEED_WORDS} | ({1, 2} if any(len(w) < SEED_WORDS for w in block.words) else set()):
        if len(h) < n:
            continue
        grams = windows(h, n)
        for p in np.flatnonzero(block.flags[grams >> np.uint64(64 - _FLAGS)]).tolist():
            for item, place in block.seeds.get(int(grams[p]), ()):
                found.setdefault(item, []).append(p - place)
    out = []
    for item, starts in found.items():
        w, best = block.words[item], None
        starts = sorted(set(starts))
        groups = np.split(np.array(starts), np.flatnonzero(np.diff(starts) > len(w)) + 1)
        for group in groups:
            low, high = max(0, int(group[0]) - len(w) // 2), int(group[-1]) + len(w) + len(w) // 2
            score, matched, start, end = align(w, h[low:high])
            copied = score >= LEAST_SCORE * MATCH * len(w) and matched >= min(LEAST_WORDS, len(w))
            excerpt = matched >= EXCERPT_WORDS and matched >= EXCERPT_SHARE * (end - start)
            if not copied and not excerpt:
                continue
            if best is None or score > best["score"]:
                best = {"item_id": block.ids[item], "score": score / (MATCH * len(w)), "matched_words": matched, "start_word": low + start, "end_word": low + end}
        if best:
            out.append(best)
    return out


def word_bits(docs: DataFrame, vocabulary: np.ndarray) -> dict[int, float]:
    """-log2 of the frequency of each word of ``vocabulary`` (sorted) in all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, sums, total = PlainWords(), np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            for text in batch.text:
                h = plain_words(text, known)
                total += len(h)
                place = np.searchsorted(vocabulary, h)
                place[place == len(vocabulary)] = 0
                sums += np.bincount(place[vocabulary[place] == h], minlength=len(vocabulary))
        some = np.flatnonzero(sums)
        yield pd.DataFrame({"place": np.append(some, -1), "n": np.append(sums[some], total)})

    rows = small_batches(docs).select("text").mapInPandas(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    n = {r.place: r.n for r in rows}
    return {int(w): math.log2((n.get(-1, 0) + 1) / (n.get(i, 0) + 1)) for i, w in enumerate(vocabulary.tolist())}


def blocks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark by blocks; texts without words are left out."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-size // (6 * block_words)))
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        known = PlainWords()
        words = [plain_words(r.text, known) for r in rows]
        some = [i for i, w in enumerate(words) if len(w)]
        if some:
            words, ids = [words[i] for i in some], [rows[i].item_id for i in some]
            yield Block.of(ids, words, word_bits(docs, np.unique(np.concatenate(words))))


def with_leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS, into: str = "leaks") -> DataFrame:
    """``docs`` with the column ``into``: the benchmark items that the text holds, as structs of
    item_id, score (1 for a full copy), matched_words, start_word and end_word.

    Null and empty texts hold none, and an empty benchmark is held by none. Rows are judged one
    by one: null or repeated ids need no rule. Repeated items are found each. An own column of
    ``docs`` of that name is replaced.
    """
    kind = "array<struct<item_id long, score double, matched_words int, start_word int, end_word int>>"
    def search(block: Block):
        @F.pandas_udf(kind)
        def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known = PlainWords()
            for texts in batches:
                yield pd.Series([leaks(plain_words(t, known), block) for t in texts], dtype=object)

        return found("text")

    found = [search(block) for block in blocks(docs, benchmark, block_words)]
    none = F.array().cast(kind)
    return small_batches(docs).withColumn(into, F.concat(none, *found))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, matched_words, start_word, end_word: a row for each item in a document."""
    # stored, as both the condition and the rows read the search
    found = keep(with_leaks(docs.select("doc_id", "text"), benchmark), "leaks")
    return found.where(F.size("leaks") > 0).select("doc_id", F.inline("leaks"))
