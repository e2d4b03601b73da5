"""Hard negatives by slot-decomposed selection.

An anchor's positives are the best rows of its label. Each positive allows the negatives whose
score lies between a share of its own score and that score; such windows overlap. The distinct
upper limits of an anchor's windows split the scores into disjoint slots, from one limit down to
the next. Tasks keep the best k of each slot only. A window begins at the top of one slot, so its
answer is the best k of that slot and all below it (a suffix of the slots), cut at the lower limit.

Vectors are packed into binary blocks where they lie; anchors into blocks of bounded size. Each
vector block meets each anchor block in one of the cells of a grid, and a cell is a bounded piece of work,
so no key, label or group of copies gathers in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.storage import keep

K = 5
LEAST_PERCENT = 80  # of a positive's score that a negative's score must reach
SCALE = 256
ROWS_PER_BLOCK = 2048  # of vectors, at most
BLOCK_BYTES = 1 << 20  # of vectors in a block, in expectation
ANCHORS_PER_BLOCK = 4096
ANCHOR_BYTES = 4 << 20  # of vectors in an anchor block, in expectation
BLOCKS_PER_CELL = 64  # vector blocks that one cell compares with its anchor block
PRODUCTS = 1 << 20  # inner products that a task holds at once
OPEN = 8  # anchor blocks whose best a task holds at once
NO_ID = (1 << 63) - 1  # stands for a null id, so that it comes last among ties
LOWEST = -NO_ID


def usable(rows: DataFrame, vec_id: str, vector: str, label: Column, anchor: Column, scale: float = SCALE) -> DataFrame:
    """id, vector, label, is_anchor of the rows that take part: label and vector are there, and so
    are all components, finite also after scaling."""
    sound = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < float("inf")))
    kept = rows.where(F.col(vector).isNotNull() & sound & label.isNotNull())
    return kept.select(F.coalesce(F.col(vec_id), F.lit(NO_ID)).cast("long").alias("id"), F.col(vector).alias("vector"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))


def blocks(rows: DataFrame, bounded: bool) -> DataFrame:
    """dim, ids, labels, vectors: rows packed where they lie, per length of their vectors;
    ``bounded``: into blocks of about BLOCK_BYTES, else into one for each length and task."""
    kind = rows.schema["vector"].dataType.elementType
    width = np.float32 if isinstance(kind, T.FloatType) else np.float64

    def block(dim: int, parts: list[pd.DataFrame]) -> pd.DataFrame:
        joined = pd.concat(parts)
        data = np.concatenate([np.asarray(v, width) for v in joined.vector]) if dim else np.empty(0, width)
        return pd.DataFrame([{"dim": dim, "ids": joined.id.to_numpy(np.int64).tobytes(), "labels": joined.label.to_numpy(np.int64).tobytes(), "vectors": data.tobytes()}])

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, list[pd.DataFrame]] = {}
        held: dict[int, int] = {}
        for batch in batches:
            for dim, part in batch.groupby(batch.vector.map(len)):
                most = max(16, min(ROWS_PER_BLOCK, BLOCK_BYTES // (width().nbytes * max(1, dim))))
                for start in range(0, len(part), most):
                    piece = part.iloc[start : start + most]
                    if bounded and held.get(dim, 0) + len(piece) > most:
                        yield block(dim, waiting.pop(dim))
                        held[dim] = 0
                    waiting.setdefault(dim, []).append(piece)
                    held[dim] = held.get(dim, 0) + len(piece)
        for dim, parts in waiting.items():
            yield block(dim, parts)

    cast = F.col("vector") if isinstance(kind, T.FloatType) else F.col("vector").cast("array<double>")
    return rows.select("id", "label", cast.alias("vector")).mapInPandas(pack, "dim int, ids binary, labels binary, vectors binary").withColumn("width", F.lit(width().nbytes))


def scaled(data: bytes, dim: int, width: int, n: int, scale: float) -> np.ndarray:
    return np.floor(np.frombuffer(data, f"<f{width}").astype(np.float64).reshape(n, dim) * scale)


def products(v: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Integer inner products of whole-numbered rows; beyond a long, the nearest long but one."""
    with np.errstate(invalid="ignore", over="ignore"):
        out = v @ a.T
        most_v, most_a = np.abs(v).max(axis=1, initial=0), np.abs(a).max(axis=1, initial=0)
        safe = 2.0**53
        if most_v.max(initial=0) * most_a.max(initial=0) * max(1, v.shape[1]) < safe:
            return out.astype(np.int64)  # every partial sum is exact
        inexact = most_v[:, None] * most_a[None, :] * v.shape[1] >= safe
        whole = out.astype(np.int64)
    r, c = np.flatnonzero(inexact.any(axis=1)), np.flatnonzero(inexact.any(axis=0))
    exact = np.array([[int(x) for x in row] for row in v[r]], object) @ np.array([[int(x) for x in row] for row in a[c]], object).T
    whole[np.ix_(r, c)] = np.clip(exact, LOWEST, -LOWEST).astype(np.int64)
    return whole


class Best:
    """The best k (score, id) of each key: higher scores, then smaller ids."""

    def __init__(self, keys: int, k: int):
        self.k = k
        self.key, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.least = np.full(keys, LOWEST, np.int64)  # score that a further one must reach

    def add(self, key: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        key, score, id_ = (np.concatenate(x) for x in ((self.key, key), (self.score, score), (self.id, id_)))
        order = np.lexsort((id_, -score, key))
        key, score, id_ = key[order], score[order], id_[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        rank = np.arange(len(key)) - np.repeat(first, np.diff(np.r_[first, len(key)]))
        kept = rank < self.k
        self.key, self.score, self.id = key[kept], score[kept], id_[kept]
        full = rank == self.k - 1
        self.least[key[full]] = score[full]


class Selection:
    """The best of an anchor block so far; ``limits``: None to look for positives, else for each
    anchor its windows' upper limits, descending, and the least of their lower limits."""

    def __init__(self, r, k: int, scale: float):
        self.ids, self.labels = np.frombuffer(r.anchor_ids, np.int64), np.frombuffer(r.anchor_labels, np.int64)
        self.vectors = scaled(r.anchor_vectors, r.dim, r.width, len(self.ids), scale)
        self.limits, self.floor, self.slots = None, None, 1
        if hasattr(r, "limits"):
            floor = np.frombuffer(r.floors, np.int64)
            limits = np.frombuffer(r.limits, np.int64).reshape(len(floor), -1)
            rest = len(self.ids) - len(floor)  # anchors behind the last one that has a positive
            self.floor = np.r_[floor, np.full(rest, NO_ID)]
            self.slots = limits.shape[1]
            self.limits = np.concatenate([limits, np.full((rest, self.slots), LOWEST)])
        self.best = Best(len(self.ids) * self.slots, k)

    def meet(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, PRODUCTS // max(1, len(self.ids)))
        for start in range(0, len(ids), step):
            part = slice(start, start + step)
            score = products(vectors[part], self.vectors)
            same, other = labels[part, None] == self.labels, ids[part, None] != self.ids
            if self.limits is None:
                row, at = np.nonzero(same & other & (score >= self.best.least))
                key, found = at, score[row, at]
            else:
                row, at = np.nonzero(~same & other & (score <= self.limits[:, 0]) & (score >= self.floor))
                found = score[row, at]
                key = at * self.slots + (self.limits[at] >= found[:, None]).sum(axis=1) - 1
                open_ = found >= self.best.least[key]
                row, key, found = row[open_], key[open_], found[open_]
            if len(row):
                self.best.add(key, found, ids[part][row])


def _selected(cells: DataFrame, k: int, scale: float) -> DataFrame:
    """block, dim, at (the anchor's place), anchor_id, slot, score, id: the best of each task."""

    def select(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_: dict[tuple[int, int], Selection] = {}

        def done(name: tuple[int, int]) -> pd.DataFrame:
            s = open_.pop(name)
            at, slot = s.best.key // s.slots, s.best.key % s.slots
            return pd.DataFrame({"block": name[0], "dim": name[1], "at": at, "anchor_id": s.ids[at], "slot": slot, "score": s.best.score, "id": s.best.id})

        for batch in batches:
            for r in batch.itertuples():
                name = (r.block, r.dim)
                if name not in open_:
                    if len(open_) >= OPEN:
                        yield done(next(iter(open_)))
                    open_[name] = Selection(r, k, scale)
                ids = np.frombuffer(r.ids, np.int64)
                open_[name].meet(ids, np.frombuffer(r.labels, np.int64), scaled(r.vectors, r.dim, r.width, len(ids), scale))
        for name in list(open_):
            yield done(name)

    schema = "block long, dim int, at long, anchor_id long, slot long, score long, id long"
    return cells.mapInPandas(select, schema)


ANCHOR = ("block", "dim", "at", "anchor_id")


def _ranked(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The best k of all tasks, with ``rank``. A key has at most k rows from each cell."""
    order = Window.partitionBy(*ANCHOR, *keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, vec_id: str, vector: str, label: Column, anchor: Column, k: int = K, positives: int = K, least_percent: int = LEAST_PERCENT, scale: float = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become ``floor(scale * x)``; a score is the integer inner product with the anchor's
    vector, in a long (a sum beyond it counts as the largest one). Rows with a null label, vector or component, or
    with one that is not finite, take no part; only vectors of one length have a score. For each row with ``anchor`` true,
    the best ``positives`` other rows of its label, and for each of these the best ``k`` rows of
    other labels that score from ``least_percent`` percent of its score up to its score (none, if
    it is negative). Ties go to smaller ids, rows without id last; these
    are no anchors. Rows of the anchor's own id are never its positives or negatives; otherwise
    rows that repeat count one by one. Other columns are not read. An empty table gives an empty
    result.
    """
    good = usable(rows, vec_id, vector, label, anchor & F.col(vec_id).isNotNull(), scale)
    anchors = keep(good.where("is_anchor").drop("is_anchor"), "anchor-rows")
    n, floats = anchors.agg(F.count("*"), F.coalesce(F.sum(F.size("vector")), F.lit(0))).first()
    n_blocks = max(1, -(-n // ANCHORS_PER_BLOCK), -(-floats * 4 // ANCHOR_BYTES))
    packed = blocks(anchors.repartition(n_blocks), bounded=False)
    packed = keep(packed.select(F.spark_partition_id().cast("long").alias("block"), "dim", *[F.col(c).alias(f"anchor_{c}") for c in ("ids", "labels", "vectors")]), "anchors")
    vectors = keep(blocks(good, bounded=True), "vectors")
    n_vectors = vectors.count()
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, -(-n_vectors // BLOCKS_PER_CELL), min(n_vectors, -(-tasks // n_blocks)))
    dealt = vectors.withColumn("slice", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(slices)).cast("int"))
    cell = ("block", "slice", "dim")

    def cells(of: DataFrame) -> DataFrame:
        left = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn("block", F.col("block").cast("long"))
        right = of.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        parts = n_blocks * slices
        return left.repartition(parts, *cell).join(right.repartition(parts, *cell), list(cell))

    near = keep(_ranked(_selected(cells(packed), positives, scale), positives), "positives")
    near = near.select(*ANCHOR, F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "rank")
    lower = F.ceil(F.col("positive_score").cast("decimal(20,0)") * F.lit(least_percent) / F.lit(100)).cast("long")
    near = near.withColumn("lower", F.when(F.col("positive_score") >= 0, lower))
    near = keep(near.withColumn("slot", F.dense_rank().over(Window.partitionBy(*ANCHOR).orderBy(F.col("positive_score").desc())) - 1), "windows")

    found = _ranked(_selected(cells(packed.join(_limits(near, positives), ["block", "dim"])), k, scale), k, "slot")
    best = found.groupBy(*ANCHOR).agg(F.sort_array(F.collect_list(F.struct("slot", (-F.col("score")).alias("under"), "id"))).alias("best"))
    # of the window's slot and all below it, the best k: a suffix of the sorted slots
    suffix = F.slice(F.filter("best", lambda e: e["slot"] >= F.col("slot")), 1, k)
    inside = F.filter(suffix, lambda e: -e["under"] >= F.col("lower"))
    out = near.where("lower is not null").drop("rank").join(best, list(ANCHOR)).select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("i", "n"))
    named = lambda c: F.when(F.col(c) < NO_ID, F.col(c))
    return out.select("anchor_id", named("positive_id").alias("positive_id"), (F.col("i") + 1).cast("int").alias("rank"), named("n.id").alias("negative_id"), "positive_score", (-F.col("n.under")).alias("negative_score"))


def _limits(near: DataFrame, positives: int) -> DataFrame:
    """block, dim, limits, floors: for each anchor of a block (no windows: limits below any score)."""

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["size"].iloc[0])
        limits, floors = np.full((n, positives), LOWEST, np.int64), np.full(n, NO_ID, np.int64)
        limits[pdf["at"], pdf["slot"]] = pdf["positive_score"]
        np.minimum.at(floors, pdf["at"], pdf["lower"])
        return pd.DataFrame([{"block": pdf["block"].iloc[0], "dim": pdf["dim"].iloc[0], "limits": limits.tobytes(), "floors": floors.tobytes()}])

    sizes = near.groupBy("block", "dim").agg((F.max("at") + 1).alias("size"))
    rows = near.where("lower is not null").join(sizes, ["block", "dim"]).select("block", "dim", "size", "at", "slot", "positive_score", "lower")
    return rows.groupBy("block", "dim").applyInPandas(gather, "block long, dim int, limits binary, floors binary")
