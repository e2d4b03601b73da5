"""Near-duplicate documents: HyperMinHash sketches, banded registers, exact confirmation.

1. A text's distinct word shingles are hashed. A hash's top bits choose a register; a register
   keeps, of the least hash in it, the number of leading zeros and the mantissa bits behind them.
2. Texts with equal shingle sets form a class; the least id stands for it from here on.
3. Empty registers borrow from hashed other ones, and runs of registers are hashed to band keys.
   Representatives that share a band key are candidates. Keys shared by few are paired directly.
   In larger groups each text is first compared with one other: the member of its largest group
   that shares most bands with others. Then, in the groups that this has not joined, that member is compared with
   all, and then a growing number of pivots with the members that no link has joined to them
   yet; so a group of near copies costs about its size and not its square.
4. A candidate pair is dropped if its collision-corrected Jaccard estimate lies more than five
   standard deviations below the threshold, and else confirmed on the full shingle sets.
5. Links are closed to components.

With BANDS bands of ROWS registers, a pair at a threshold of 0.85 shares no band with a chance
of about (1 - 0.85 ** 6) ** 42, 2e-9; at 0.8 of (1 - 0.8 ** 6) ** 42, 3e-6.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.components import components
from shelfmark.llm.storage import bounded, distil, keep, small_batches
from shelfmark.llm.words import WordHashes, give_back, mixed, signed, slices, to_bytes, windows

WORDS = 5
PERCENT = 85  # least Jaccard similarity of a link, unless the caller names another
PRECISION_BITS = 8  # 256 registers
MANTISSA_BITS = 10
REGISTERS = 1 << PRECISION_BITS
ROWS, BANDS = 6, 42
EMPTY = 0xFFFF
TRIES = 64  # other registers that an empty one asks before it takes the next filled one
FEW = 32  # members of a band key up to which all pairs are compared at once
PIVOTS = 32  # of a larger band key in the second round; eight times as many in each further one
SIGMAS = 5  # standard deviations by which an estimate may miss the threshold
SMALL_SET = 256  # shingles of a set that pivots are compared with itself
HINT_BITS = 4  # low bits of the mantissas that pivots are compared by
BROADCAST_IDS = 500_000  # candidate ids that are broadcast at once, about 35 MB in the driver's memory
MOST_READS = 16  # times that texts are read for candidates; with more of these, texts move instead
HINT_ROWS = 50_000  # rows of members with hints (2 KB each at most) that a join may send through the driver

_DONORS = (mixed(np.arange(TRIES * REGISTERS, dtype=np.uint64) + np.uint64(1)) >> np.uint64(64 - PRECISION_BITS)).astype(np.int64).reshape(TRIES, REGISTERS)


def shingle_set(text: str | None, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    return np.unique(windows(known.of(to_bytes(text).lower().split()), WORDS))


def registers(hashes: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of the least hash of each register; EMPTY without one."""
    out = np.full(REGISTERS, EMPTY, np.uint16)
    which, first = np.unique(hashes >> np.uint64(64 - PRECISION_BITS), return_index=True)  # hashes are sorted
    # 53 bits fit a float exactly
    share, bits = np.frexp(((hashes[first] << np.uint64(PRECISION_BITS)) >> np.uint64(11)).astype(np.float64))
    mantissa = np.where(bits > 0, (2 * share - 1) * (1 << MANTISSA_BITS), 0).astype(np.int64)
    out[which.astype(np.int64)] = ((53 - bits) << MANTISSA_BITS) + mantissa
    return out


def filled(sketches: np.ndarray) -> np.ndarray:
    """Sketches (a row each, not all empty) whose empty registers hold a borrowed value."""
    out = sketches.copy()
    for donors in _DONORS:
        rows = np.flatnonzero((out == EMPTY).any(axis=1))
        if not len(rows):
            return out
        part = out[rows]
        out[rows] = np.where(part == EMPTY, sketches[rows][:, donors], part)
    for i in np.flatnonzero((out == EMPTY).any(axis=1)):
        own = np.flatnonzero(sketches[i] != EMPTY)
        gaps = np.flatnonzero(out[i] == EMPTY)
        out[i, gaps] = sketches[i, own[np.searchsorted(own, gaps) % len(own)]]
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    parts = filled(sketches)[:, : ROWS * BANDS].reshape(len(sketches), BANDS, ROWS).astype(np.uint64)
    out = np.tile(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(sketches), 1))
    for j in range(ROWS):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return out


def sketched(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, d1 and d2 (128 bits that tell shingle sets apart), bands: a row per row.

    Sets too small to have a near but unequal one (n - 1 of n shingles is under the threshold)
    have no bands.
    """
    least = -(-100 // (100 - percent)) - 1

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in (part for whole in batches for part in slices(whole)):
            n, d1, d2, large = [], [], [], {}
            for i, text in enumerate(batch.text):
                h = shingle_set(text, known)
                n.append(len(h))
                d1.append(mixed(h).sum(dtype=np.uint64))
                d2.append(np.bitwise_xor.reduce(mixed(h + np.uint64(len(h)))) if len(h) else 0)
                if len(h) >= least:
                    large[i] = registers(h)
            bands: list = [[]] * len(n)
            if large:
                for i, keys in zip(large, signed(band_keys(np.stack(list(large.values()))))):
                    bands[i] = keys
            yield pd.DataFrame({"doc_id": batch.doc_id, "n_shingles": np.array(n, np.int64), "d1": signed(np.array(d1, np.uint64)), "d2": signed(np.array(d2, np.uint64)), "bands": bands})
        give_back(known)

    return small_batches(docs).select("doc_id", "text").mapInPandas(sketch, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>")


def _of_ids(docs: DataFrame, ids: DataFrame, read: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """What ``read`` makes of doc_id and text of the documents in ``ids``, stored.

    No text moves: ids are broadcast, BROADCAST_IDS of them at a time, and the texts read again for
    the next ones. So what the driver holds of them does not grow.
    """
    texts, shares = docs.select("doc_id", "text"), max(1, -(-ids.count() // BROADCAST_IDS))
    if shares > MOST_READS:
        return keep(read(texts.join(ids.hint("merge"), "doc_id", "left_semi")), name)
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(shares))
    return reduce(DataFrame.unionByName, [keep(read(texts.join(F.broadcast(ids.where(dealt == i)), "doc_id", "left_semi")), name) for i in range(shares)])


def with_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, shingles, registers of the documents in ``ids``, stored: the text is hashed once more."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in (part for whole in batches for part in slices(whole)):
            sets = [shingle_set(t, known) for t in batch.text]
            yield pd.DataFrame({"doc_id": batch.doc_id, "shingles": [signed(h) for h in sets], "registers": [registers(h).astype(np.int32) for h in sets]})
        give_back(known)

    return _of_ids(docs, ids, lambda texts: texts.mapInPandas(read, "doc_id long, shingles array<long>, registers array<int>"), "sets")


def estimate(a: Column, b: Column, n_a: Column, n_b: Column) -> tuple[Column, Column]:
    """Jaccard estimate from two sketches, less the collisions expected by chance, and the number
    of registers that it rests on."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when((x == y) & (x != EMPTY), 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    used = F.aggregate(F.zip_with(a, b, lambda x, y: F.when((x != EMPTY) | (y != EMPTY), 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    ratio = F.least(n_a, n_b) / F.greatest(n_a, n_b)
    chance = 0.169919487 * 2.0 ** (PRECISION_BITS - MANTISSA_BITS + 1) * 4 * ratio / (1 + ratio) ** 2
    return (same - chance) / used, used


def _near(a: Column, b: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """The estimate is not SIGMAS standard deviations below the threshold."""
    jaccard, used = estimate(a, b, n_a, n_b)
    t = percent / 100
    return jaccard >= t - SIGMAS * F.sqrt(t * (1 - t) / used)


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The links among ``pairs`` (a, b): a, b."""
    pairs = bounded(keep(pairs.select("a", "b").distinct(), "pairs"))
    sets = with_sets(docs, keep(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "candidates"))
    side = lambda s, what: sets.select(F.col("doc_id").alias(s), F.size("shingles").alias(f"n_{s}"), F.col(what).alias(f"x_{s}"))
    near = pairs.join(side("a", "registers"), "a").join(side("b", "registers"), "b")
    near = bounded(keep(near.where(_near(F.col("x_a"), F.col("x_b"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b"), "near"))
    common = F.size(F.array_intersect("x_a", "x_b"))
    full = near.join(side("a", "shingles"), "a").join(side("b", "shingles"), "b")
    return full.where(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b").distinct()


def _alike(n_a: str, n_b: str, percent: int) -> Column:
    """Sizes that allow the threshold."""
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def linked(docs: DataFrame, sketches: DataFrame, percent: int = PERCENT) -> DataFrame:
    """id, component: of all class representatives that are linked to another one."""
    spark = docs.sparkSession
    classes = sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).groupBy("d1", "d2").agg(F.min("doc_id").alias("doc_id"))
    reps = sketches.join(bounded(keep(classes.select("doc_id").distinct(), "representatives")), "doc_id", "left_semi")
    banded = reps.select(F.explode("bands").alias("band"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"))
    # bands move once, to be counted and kept: most have one member
    of_band = Window.partitionBy("band")
    counted = banded.withColumns({"members": F.count("*").over(of_band), "_low": F.min("id").over(of_band), "_high": F.max("id").over(of_band)})
    members = bounded(keep(counted.where("_low < _high").drop("_low", "_high"), "band-members"))

    left = members.where(F.col("members") <= FEW).select("band", F.col("id").alias("a"), F.col("n").alias("n_a"))
    right = members.where(F.col("members") <= FEW).select("band", F.col("id").alias("b"), F.col("n").alias("n_b"))
    few = left.join(right, "band").where((F.col("a") < F.col("b")) & _alike("n_a", "n_b", percent))
    links = distil(spark, lambda: confirmed(few, docs, percent), "confirmed")
    labels = components(links)

    large = bounded(keep(members.where(F.col("members") > FEW), "large-bands"))
    if large.isEmpty():
        return labels
    found = distil(spark, lambda: confirmed(_home_pairs(large, labels, percent), docs, percent), "confirmed")
    if not found.isEmpty():
        links = keep(links.unionByName(found), "links")
        labels = components(links)
    active = large.drop("members")
    drawn_of, hints = 0, None
    while True:
        # members of a band that is one component have nothing more to find in it
        at = bounded(keep(active.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")), "large-bands"))
        open_ = at.groupBy("band").agg(F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").drop("low", "high")
        at = bounded(keep(at.join(open_, "band"), "large-bands"))
        if at.isEmpty():
            return labels
        if hints is None:
            hints = hinted(docs, keep(at.select(F.col("id").alias("doc_id")).distinct(), "hint-ids"))
        if drawn_of:
            at = at.withColumn("pivot", F.pmod(F.xxhash64("id", F.lit(drawn_of)), F.lit(1 << 30)) < F.lit(drawn_of * float(1 << 30)) / F.col("members"))
        else:
            # the text that most others were made from shares most bands with them
            weighed = at.groupBy("id").agg(F.sum("members").alias("weight"), F.collect_list("band").alias("held")).select("id", "weight", F.explode("held").alias("band"))
            heart = weighed.groupBy("band").agg(F.max(F.struct("weight", -F.col("id"))).alias("most")).select("band", (-F.col("most.col2")).alias("p"))
            at = at.join(heart, "band").withColumn("pivot", F.col("id") == F.col("p")).drop("p")
        at = bounded(keep(at.drop("members"), "large-bands"))
        rows, probe = _with_hints(at, hints), _with_hints(at.where("pivot").drop("pivot"), hints)
        rows = rows if at.count() <= HINT_ROWS else rows.hint("merge")
        probe = probe.select("band", *[F.col(c).alias(f"{c}_p") for c in probe.columns if c != "band"])
        pairs = probe.join(rows, "band").where((F.col("component_p") != F.col("component")) & _alike("n_p", "n", percent) & _may_link(percent))
        pairs = pairs.select(F.least("id_p", "id").alias("a"), F.greatest("id_p", "id").alias("b"))
        found = distil(spark, lambda: confirmed(pairs, docs, percent), "confirmed")
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = components(links)
        # a pivot has met all others of its band
        active = at.where(~F.col("pivot")).select("band", "id", "n")
        drawn_of = drawn_of * 8 or PIVOTS


def _home_pairs(large: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """a, b: each text of large bands with the member of its largest one that shares most bands
    with others. One row for each text, however many bands it has."""
    homes = large.groupBy("id").agg(F.max(F.struct("members", "band"))["band"].alias("home"), F.sum("members").alias("weight"), F.first("n").alias("n"))
    homes = keep(homes.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")), "homes")
    heart = homes.groupBy("home").agg(F.max(F.struct("weight", (-F.col("id")).alias("other"), "component", "n")).alias("most"))
    met = homes.join(heart, "home").withColumns({"p": -F.col("most.other"), "n_p": F.col("most.n")})
    met = met.where((F.col("component") != F.col("most.component")) & _alike("n_p", "n", percent))
    return met.select(F.least("p", "id").alias("a"), F.greatest("p", "id").alias("b"))


def hinted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id, used (registers that the text itself fills), planes (HINT_BITS bit planes of the filled
    registers, as 64-bit words), few (the shingles of a text that has at most SMALL_SET); stored."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in (part for whole in batches for part in slices(whole)):
            sets = [shingle_set(t, known) for t in batch.text]
            if sets:
                raw = np.stack([registers(h) for h in sets])
                bits = filled(raw)[:, None, :] >> np.arange(HINT_BITS, dtype=np.uint16)[:, None] & 1
                planes = np.packbits(bits.astype(bool), axis=2).reshape(len(sets), -1).view(np.int64)
                yield pd.DataFrame({"id": batch.doc_id, "used": (raw != EMPTY).sum(axis=1).astype(np.int32), "planes": list(planes), "few": [signed(h) if len(h) <= SMALL_SET else None for h in sets]})
        give_back(known)

    return _of_ids(docs, ids, lambda texts: texts.mapInPandas(read, "id long, used int, planes array<long>, few array<long>"), "hints")


def _with_hints(at: DataFrame, hints: DataFrame) -> DataFrame:
    """The rows of ``at`` with the hints of their texts. They are joined once for each text, which
    has at most BANDS rows, and not once for each band that it is in."""
    texts = at.groupBy("id").agg(F.collect_list(F.struct(*[c for c in at.columns if c != "id"])).alias("places"))
    return texts.join(hints, "id").select("id", *[c for c in hints.columns if c != "id"], F.inline("places"))


def _may_link(percent: int) -> Column:
    """Of a pivot (columns ending in _p) and a member: the registers agree in the hint bits often
    enough, and small sets overlap enough. Hint bits that agree by chance are allowed for."""
    words = REGISTERS // 64
    differ = F.lit(0)
    for i in range(words):
        any_ = F.lit(0).cast("long")
        for plane in range(HINT_BITS):
            at = F.lit(plane * words + i)
            any_ = any_.bitwiseOR(F.get("planes_p", at).bitwiseXOR(F.get("planes", at)))
        differ = differ + F.bit_count(any_)
    t = percent / 100
    jaccard = 1 - differ / (REGISTERS * (1 - 2.0**-HINT_BITS))
    alike = jaccard >= t - SIGMAS * F.sqrt(t * (1 - t) / F.least("used_p", "used"))
    common = F.size(F.array_intersect("few_p", "few"))
    both = F.col("few_p").isNotNull() & F.col("few").isNotNull()
    return F.when(alike, F.when(both, 100 * common >= percent * (F.col("n_p") + F.col("n") - common)).otherwise(True)).otherwise(False)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``. Texts whose
    shingle sets have a Jaccard similarity of ``percent`` or more are linked.

    Texts without words (null, empty) have no shingles and are linked with nothing. Rows that
    repeat an id are one document in the links: all have one component, and all are kept if its
    least id is theirs. Rows without id are linked with nothing and kept, with a null component.
    Columns other than doc_id and text are not read.
    """
    sketches = keep(sketched(docs, percent), "sketches")
    labels = bounded(distil(docs.sparkSession, lambda: linked(docs, sketches, percent), "components"))
    usable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    classes = sketches.where(usable).groupBy("d1", "d2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    # the class of each document that is not alone, then the component of its representative
    shared = bounded(keep(classes.where("first < last").select("d1", "d2", "first"), "classes"))
    out = sketches.select("doc_id", "n_shingles", "d1", "d2").join(shared, ["d1", "d2"], "left")
    out = out.withColumn("_rep", F.when(usable, F.coalesce("first", "doc_id")))
    out = out.join(labels.withColumnRenamed("id", "_rep"), "_rep", "left")
    component = F.coalesce("component", "_rep", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
