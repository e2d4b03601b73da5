"""Language-model scores from a log-frequency Bloom filter.

The model interpolates word bigrams and unigrams. Counts are quantised to their logarithm and
kept in Bloom filters: an n-gram of level q is inserted with each of the numbers 1 to q, and a
level is read back by probing 1, 2, ... until a probe fails.

Documents are dealt to batches, n-grams to parts, both sized by the text. A batch sends each part
its distinct n-grams with their counts, so a word with a third of all tokens is one number per
batch. A part sums them, builds its filter, and answers each batch with the exact unigram counts
that the base score is made of. While the filters have a proven bound of BROADCAST_BYTES in all
they are broadcast and batches probe them; beyond it, parts probe for the batches and answer
with the levels. Both give the same scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.storage import keep
from shelfmark.llm.words import WordHashes, mixed, to_bytes

BATCH_BYTES = 8_000_000  # of text, expected
BROADCAST_BYTES = 1 << 30  # bound of the filters; they come to about an eighth of it
PROBES = 4  # hash functions: an absent n-gram passes with a chance of about 2 ** -PROBES
BASE = 1.5  # of the logarithm
DISCOUNT = 0.75  # of unigram counts
PRIOR = 5.0  # tokens of unigram model that each history is mixed with
SHARES = (0.3, 0.5, 0.7, 0.85, 0.95, 1.0)  # of the unigram model; chosen by leaving one out
#: The end of a text, also the history of its first word; no word holds a space.
END = np.uint64(xxhash.xxh64_intdigest(b" "))
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def bigrams(h: np.ndarray) -> np.ndarray:
    """Hash of each token of a text (END last) behind its history."""
    return mixed(np.append(h[-1:], h[:-1]) * _TWO + h)


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash; parts are ranges of hashes."""
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def packed(sorted_: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences, byte plane by byte plane."""
    steps = np.diff(sorted_.astype(np.uint64), prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def packed_numbers(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x, np.uint32).tobytes())


def unpacked_numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint32)


def levels(counts: np.ndarray) -> np.ndarray:
    """0 for 0, else 1 + the whole part of the logarithm."""
    return np.where(counts > 0, 1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(BASE) + 1e-9), 0).astype(np.int64)


def counts_of(level: np.ndarray) -> np.ndarray:
    """The middle of the counts with a level; exact for counts that have a level of their own."""
    top = int(level.max(initial=0)) + 2
    low = np.ceil(BASE ** np.arange(-1, top, dtype=float) - 1e-9)
    middle = np.maximum((low[:-1] + np.maximum(low[1:] - 1, low[:-1])) / 2, 1)
    middle[0] = 0
    return middle[level]


def _spots(h: np.ndarray, level: int, bits: int) -> Iterator[np.ndarray]:
    a = mixed(h + np.array([level], np.uint64) * _ONE)
    b = mixed(a + _TWO) | np.uint64(1)
    for i in range(PROBES):
        yield ((a + np.uint64(i) * b) % np.uint64(bits)).astype(np.int64)


def filled_filter(h: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Bits, eight to a byte, of a filter that holds each hash with its levels."""
    bits = max(64, -(-math.ceil(int(level.sum()) * PROBES / math.log(2)) // 8) * 8)
    flags = np.zeros(bits, bool)
    for q in range(1, int(level.max(initial=0)) + 1):
        for spots in _spots(h[level >= q], q, bits):
            flags[spots] = True
    return np.packbits(flags)


def probed(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The level of each hash: the number of successive probes that succeed."""
    out = np.zeros(len(h), np.int64)
    open_, q = np.arange(len(h)), 1
    while len(open_):
        passed = np.ones(len(open_), bool)
        for spots in _spots(h[open_], q, 8 * len(filter_)):
            passed &= (filter_[spots >> 3] >> (7 - (spots & 7)).astype(np.uint8) & 1).astype(bool)
        open_ = open_[passed]
        out[open_] = q
        q += 1
    return out


def _tagged(unigrams: np.ndarray) -> np.ndarray:
    """Keys of unigrams in a filter that also holds bigrams."""
    return mixed(unigrams ^ _TWO)


class Batch:
    """The tokens of some documents and their distinct n-grams."""

    def __init__(self, texts: list, trains: np.ndarray, known: WordHashes):
        tokens = [np.append(known.of(to_bytes(t).lower().split()), END) for t in texts]
        self.sizes = np.array([len(t) for t in tokens])
        self.trains = np.repeat(trains, self.sizes)
        self.h = np.concatenate(tokens)
        self.b = np.concatenate([bigrams(t) for t in tokens])

    def counted(self, x: np.ndarray, all_: bool) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams, sorted, of all or of training documents, and their training counts."""
        seen, times = np.unique(x[self.trains], return_counts=True)
        if not all_:
            return seen, times
        distinct = np.unique(x)
        counts = np.zeros(len(distinct), np.int64)
        counts[np.searchsorted(distinct, seen)] = times
        return distinct, counts


_SENT = "batch int, part int, words binary, word_counts binary, pairs binary, pair_counts binary"
_ANSWER = "batch int, part int, word_counts binary, word_levels binary, pair_levels binary, filter binary, tokens long, kinds long"


def sent(dealt: DataFrame, parts: int, ask_pairs: bool) -> DataFrame:
    """What batches send to parts."""

    def send(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, texts = WordHashes(), {}
        for pdf in rows:
            for batch, text, train in zip(pdf.batch, pdf.text, pdf.train):
                texts.setdefault(batch, []).append((text, train))
        for number in list(texts):
            own = texts.pop(number)
            batch = Batch([t for t, _ in own], np.array([x for _, x in own], bool), known)
            (w, wn), (p, pn) = batch.counted(batch.h, True), batch.counted(batch.b, ask_pairs)
            edges = [np.searchsorted(part_of(x, parts), np.arange(parts + 1)) for x in (w, p)]
            out = []
            for part in np.flatnonzero((np.diff(edges[0]) > 0) | (np.diff(edges[1]) > 0)).tolist():
                a, b = (slice(e[part], e[part + 1]) for e in edges)
                out.append((number, part, packed(w[a]), packed_numbers(wn[a]), packed(p[b]), packed_numbers(pn[b])))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _SENT.split(", ")])

    return dealt.mapInPandas(send, _SENT)


def answered(questions: DataFrame, ask_pairs: bool) -> DataFrame:
    """What parts answer to batches, and a row with each part's filter and totals (batch -1)."""

    def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        return distinct, np.bincount(which, np.concatenate(counts), len(distinct)).astype(np.int64)

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf.part.iloc[0])
        words, pairs = ([unpacked(x) for x in pdf[c]] for c in ("words", "pairs"))
        w, wn = summed(words, [unpacked_numbers(x) for x in pdf.word_counts])
        p, pn = summed(pairs, [unpacked_numbers(x) for x in pdf.pair_counts])
        filter_ = filled_filter(np.concatenate([_tagged(w), p]), levels(np.concatenate([wn, pn])))
        out = [(-1, part, None, None, None, filter_.tobytes(), int(wn.sum()), int((wn > 0).sum()))]
        for batch, own, asked in zip(pdf.batch, words, pairs):
            level = [packed_numbers(probed(filter_, x)) if ask_pairs else None for x in (_tagged(own), asked)]
            out.append((batch, part, packed_numbers(wn[np.searchsorted(w, own)]), *level, None, 0, 0))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _ANSWER.split(", ")])

    return questions.groupBy("part").applyInPandas(answer, _ANSWER)


def log_probabilities(share: float, pair: np.ndarray, history: np.ndarray, word: np.ndarray, tokens: int, kinds: int) -> np.ndarray:
    """log10 of each token's probability, from counts."""
    unigram = np.maximum(word - DISCOUNT, 0) / tokens + DISCOUNT * kinds / tokens / (kinds + 1)
    # false positives of the filter may make a pair more frequent than its history
    pair = np.minimum(pair, history)
    return np.log10(((1 - share) * pair + (share * history + PRIOR) * unigram) / (history + PRIOR))


def score_texts(docs: DataFrame, learns, batch_bytes: int = BATCH_BYTES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score: a row per row of ``docs``.

    Learns from the rows where ``learns`` holds. ``base_score`` is the add-one unigram score,
    exact; ``score`` is the interpolated model's log10 probability. The share of the unigram
    model is the one of SHARES with the best training score when each training token is left
    out of the counts. Null and empty texts have one token, the end. Without training rows both
    scores are those of a uniform model over the end alone, 0. Null ids and repeated rows are
    documents like others; columns other than doc_id and text (and what ``learns`` needs) are
    not read.
    """
    octets = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = parts = max(1, -(-octets // batch_bytes))
    # a level is at most its count, a text of n bytes has at most n / 2 + 1 tokens, each in two n-grams
    bound = 2 * (octets / 2 + 1) * PROBES / math.log(2) / 8
    ask_pairs = bound > broadcast_bytes
    batch = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(batches)).cast("int")
    dealt = docs.select("doc_id", "text", learns.alias("train"), batch.alias("batch")).repartition(batches, "batch")
    answers = keep(answered(sent(dealt.select("batch", "text", "train"), parts, ask_pairs), ask_pairs), "lm-answers")
    total = answers.where("batch < 0").agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).first()
    tokens, kinds = total.tokens or 0, total.kinds or 0
    filters = None
    if not ask_pairs:
        rows = answers.where("batch < 0").select("part", "filter").collect()
        filters = docs.sparkSession.sparkContext.broadcast({r.part: bytes(r["filter"]) for r in rows})
        del rows

    schema = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, scores array<double>, left_out array<double>"

    def score(pdf: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in schema.split(", ")]
        if pdf.empty:
            return pd.DataFrame([], columns=names)
        batch = Batch(list(pdf.text), pdf.train.to_numpy(bool), WordHashes())
        answer = answer.sort_values("part")
        starts = np.append(0, np.cumsum(batch.sizes)[:-1])
        summed = lambda x: np.add.reduceat(x, starts)
        w, of_word = np.unique(batch.h, return_inverse=True)
        exact = np.concatenate([unpacked_numbers(x) for x in answer.word_counts]).astype(np.int64)[of_word]
        base = np.log10(exact + 1.0) - math.log10(tokens + kinds + 1)
        out = {"doc_id": pdf.doc_id, "train": pdf.train, "n_tokens": batch.sizes, "n_known": summed((exact > 0).astype(np.int64)), "train_tokens": tokens, "base_score": summed(base)}
        if not tokens:
            zeros = [[0.0] * len(SHARES)] * len(pdf)
            return pd.DataFrame({**out, "scores": zeros, "left_out": zeros})

        p, of_pair = np.unique(batch.b, return_inverse=True)
        if filters is None:
            word_level, pair_level = (np.concatenate([unpacked_numbers(x) for x in answer[c]]).astype(np.int64) for c in ("word_levels", "pair_levels"))
        else:
            word_level, pair_level = np.zeros(len(w), np.int64), np.zeros(len(p), np.int64)
            for x, keys, level in ((w, _tagged(w), word_level), (p, p, pair_level)):
                edges = np.searchsorted(part_of(x, parts), np.arange(parts + 1))
                for part, bits in filters.value.items():
                    own = slice(edges[part], edges[part + 1])
                    level[own] = probed(np.frombuffer(bits, np.uint8), keys[own])
        word, pair = counts_of(word_level)[of_word], counts_of(pair_level)[of_pair]
        history = np.append(0, word[:-1])
        history[starts] = word[starts + batch.sizes - 1]  # the end is the history of the first word
        scores = np.stack([summed(log_probabilities(s, pair, history, word, tokens, kinds)) for s in SHARES], 1)
        less = [np.maximum(x - 1, 0) for x in (pair, history, word)]
        left_out = np.stack([summed(np.where(batch.trains, log_probabilities(s, *less, tokens, kinds), 0)) for s in SHARES], 1)
        return pd.DataFrame({**out, "scores": list(scores), "left_out": list(left_out)})[names]

    scored = dealt.groupBy("batch").cogroup(answers.where("batch >= 0").groupBy("batch")).applyInPandas(score, schema)
    scored = keep(scored, "lm-scores")
    sums = scored.agg(*[F.sum(F.get("left_out", F.lit(i))) for i in range(len(SHARES))]).first()
    best = max(range(len(SHARES)), key=lambda i: sums[i] if sums[i] is not None else -math.inf)
    return scored.select("doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", F.get("scores", F.lit(best)).alias("score"))
