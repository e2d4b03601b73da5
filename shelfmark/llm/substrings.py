"""Substring deduplication by content-defined chunks.

A gear rolling hash over the bytes of a text, with A-Z in lower case and all white space alike,
cuts it into chunks before words: of any WINDOW words in a row, it cuts before the one where the
hash of the last 16 bytes is least (the last of equal ones). So a passage is cut alike wherever
it stands and whatever was inserted before it. A chunk whose digest also occurs in a document
with a smaller id is a duplicate there; an unbroken run of duplicates with RUN_WORDS words or
more is a repeated span, which deduplication removes.

The ends of a passage, up to the first and from the last cut that depends on the passage alone,
belong to chunks that may differ. The hash reaches back over eight words at most, so these ends
have 8 + WINDOW - 1 and WINDOW words at most, and a passage of 50 words has a run of 25 or more.
Words of 2048 bytes and more are an exception. Digests have 64 bits: a wrong span would need
several collisions in a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.storage import OTHER_NAMES, free_name, keep, small_batches, with_names
from shelfmark.llm.words import give_back, mixed, slices, to_bytes

RUN_WORDS = 20
WINDOW = 9  # words among which there is a cut; one word in five begins a chunk, on average
LONGEST = 2048  # bytes of a chunk
PASSES = 4  # shares of the digests that are compared one after the other, so that only one of them is on disk as shuffle files

_GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_ALIKE = bytes.maketrans(b"\t\n\v\f\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"     abcdefghijklmnopqrstuvwxyz")


def cuts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """End of each chunk in bytes, and words that start before that end."""
    if not raw:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    b = np.frombuffer(raw, np.uint8)
    h = _GEAR[b]
    for width in (1, 2, 4, 8):  # h[i] then covers twice as many bytes
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h = longer
    space = _SPACE[b]
    begins = ~space
    begins[1:] &= space[:-1]
    at = np.flatnonzero(begins[1:]) + 1
    ends = np.array([len(b)])
    if len(at) >= WINDOW:
        windows = np.lib.stride_tricks.sliding_window_view(h[at - 1], WINDOW)
        least = np.arange(WINDOW - 1, len(at)) - windows[:, ::-1].argmin(axis=1)
        ends = np.append(at[np.unique(least)], len(b))
    starts = np.append(0, ends[:-1])
    if (ends - starts).max() > LONGEST:
        ends = np.unique(np.concatenate([ends, *[np.arange(s + LONGEST, e, LONGEST) for s, e in zip(starts, ends) if e - s > LONGEST]]))
    return ends, np.cumsum(begins)[ends - 1]


def _text_key() -> Column:
    return F.shiftrightunsigned(F.xxhash64("text"), 33)


def chunked(docs: DataFrame) -> DataFrame:
    """name, doc_id (as text), text_key (31 bits of the text's hash), and of each chunk digests, sizes
    (bytes) and words (that start in it): a row per row of ``docs`` with text. Names tell documents apart (see ``with_names``); those without
    id are named by a hash of their text, behind all ids."""

    def chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (part for whole in batches for part in slices(whole)):
            rows = []
            for name, doc_id, key, text in zip(batch.name, batch.doc_id, batch.text_key, batch.text):
                raw = to_bytes(text)
                if raw:
                    alike = raw.translate(_ALIKE)  # byte for byte, so places stay
                    ends, words = cuts(alike)
                    at = ends.tolist()
                    digests = [xxhash.xxh3_64_intdigest(alike[s:e]) for s, e in zip([0, *at], at)]
                    rows.append((name, doc_id, key, np.array(digests, np.uint64).view(np.int64), np.diff(ends, prepend=0).astype(np.int16), np.diff(words, prepend=0).astype(np.int16)))
            yield pd.DataFrame(rows, columns=["name", "doc_id", "text_key", "digests", "sizes", "words"])
        give_back()

    named = with_names(small_batches(docs).select("doc_id", "text"), "name").withColumn("name", F.coalesce("name", F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(OTHER_NAMES))))
    # as text, since pandas would turn a column of longs with nulls into doubles
    return named.select("name", F.col("doc_id").cast("string").alias("doc_id"), _text_key().alias("text_key"), "text").mapInPandas(chunk, "name long, doc_id string, text_key long, digests array<long>, sizes array<smallint>, words array<smallint>")


def _shared_chunks(rows: DataFrame) -> DataFrame:
    """name, at, first: of ``rows`` (digest, name, at), those whose digest has a lesser name, the first."""
    # a digest with a third of all chunks is one row of this table
    shared = keep(rows.groupBy("digest").agg(F.min("name").alias("first"), F.max("name").alias("last")).where("first < last").drop("last"), "shared-chunks")
    return keep(rows.join(shared, "digest").where("name > first").select("name", "at", "first"), "again")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, first_doc_id, start_byte, end_byte, n_chunks, n_words of each span that
    repeats text of documents with smaller ids.

    ``first_doc_id`` is the smallest of the ids that have the span's chunks; null if only documents
    without id come before. Texts without any chunk (null, empty) have no span, nor has text that
    only repeats within its own document. Rows equal in id and text are one document. Different
    texts that share an id, and different texts without id, are documents of their own: the text
    with the least hash stands at its id, the others and those without id come after all ids, in
    the order of their hashes.
    """
    chunks = keep(chunked(docs), "chunks")
    # a name that is an id stands for one text; one that is a hash has 31 bits more of the text's hash
    guard = F.when(F.col("name") >= OTHER_NAMES, F.col("text_key")).otherwise(0)
    rows = chunks.select("name", F.shiftleft(guard, 32).alias("key"), F.posexplode("digests").alias("place", "digest")).select("digest", "name", F.col("key").bitwiseOR(F.col("place")).alias("at"))
    compared = [_shared_chunks(rows.where(F.pmod("digest", F.lit(PASSES)) == share)) for share in range(PASSES)]
    # bounded by a text's own chunks
    again = F.collect_set(F.struct(F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("place"), "first"))
    per_text = reduce(DataFrame.unionByName, compared).groupBy("name", F.shiftright("at", 32).alias("guard")).agg(again.alias("again"))
    whole = chunks.select("name", guard.alias("guard"), "doc_id", "text_key", "sizes", "words")
    found = per_text.join(whole.dropDuplicates(["name", "guard"]), ["name", "guard"])

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, key, again_, sizes, words_ in zip(batch.doc_id, batch.text_key, batch.again, batch.sizes, batch.words):
                ends, words = np.cumsum(sizes, dtype=np.int64), np.cumsum(words_, dtype=np.int64)
                first = {x["place"]: x["first"] for x in again_}
                places = np.array(sorted(first))
                for run in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1):
                    a, b = run[0], run[-1]
                    n_words = int(words[b] - (words[a - 1] if a else 0))
                    if n_words >= RUN_WORDS:
                        out.append((doc_id, key, min(first[p] for p in run), int(ends[a - 1]) if a else 0, int(ends[b]), len(run), n_words))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    schema = "doc_id string, text_key long, first long, start_byte int, end_byte int, n_chunks int, n_words int"
    spans = found.select("doc_id", "text_key", "again", "sizes", "words").mapInPandas(runs, schema)
    others = chunks.where(F.col("name") >= OTHER_NAMES).select(F.col("name").alias("first"), F.col("doc_id").alias("_first_id")).dropDuplicates(["first"])
    named = lambda s, first: s.select(F.col("doc_id").cast("long").alias("doc_id"), "text_key", F.col(first).cast("long").alias("first_doc_id"), "start_byte", "end_byte", "n_chunks", "n_words")
    if others.isEmpty():
        return named(spans, "first")
    spans = keep(spans, "found-spans")
    # only names that are no ids are looked up, since many spans may share a first document
    return named(spans.where(F.col("first") < OTHER_NAMES), "first").unionByName(named(spans.where(F.col("first") >= OTHER_NAMES).join(others, "first"), "_first_id"))


def without_spans(docs: DataFrame, spans: DataFrame, changed: str) -> DataFrame:
    """``docs`` with the spans cut out of ``text``, and the boolean column ``changed``."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, holes: pd.Series) -> pd.Series:
        out = []
        for text, gaps in zip(texts, holes):
            if gaps is not None and text is not None:
                raw, at, parts = to_bytes(text), 0, []
                for gap in sorted(gaps, key=lambda g: g["start_byte"]):
                    parts.append(raw[at : gap["start_byte"]])
                    at = gap["end_byte"]
                text = b"".join([*parts, raw[at:]]).decode("utf-8", "surrogatepass").strip()
            out.append(text)
        return pd.Series(out, dtype=object)

    text_key, holes = free_name(docs, "_text_key"), free_name(docs, "_holes")
    gaps = spans.groupBy(F.col("doc_id").alias("_of"), F.col("text_key").alias("_of_text")).agg(F.collect_list(F.struct("start_byte", "end_byte")).alias("_gaps"))
    keyed = docs.withColumn(text_key, _text_key())
    joined = keyed.join(gaps, keyed["doc_id"].eqNullSafe(gaps["_of"]) & (keyed[text_key] == gaps["_of_text"]), "left")
    joined = joined.select(*[keyed[c] for c in docs.columns], gaps["_gaps"].alias(holes))
    return joined.withColumns({changed: F.col(holes).isNotNull(), "text": F.when(F.col(holes).isNotNull(), cut("text", holes)).otherwise(F.col("text"))}).drop(holes)
