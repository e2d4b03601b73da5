"""Exact global ranks, running totals and quantile tiles without a one-task sort.

``Window.orderBy`` without a partition moves every row to one task. Here the rows are
range-sorted once (ties broken by a unique column, so equal values still spread over
partitions), numbered inside their partition, and shifted by the totals of the partitions
before them. Those totals are one row per partition, the only thing that is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.session import durable

_PART = "_part"
_AT = "_at"
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def numbered(df: DataFrame, order: list[Column], running: list[str] = ()) -> DataFrame:
    """Add ``row_num``, ``total_rows`` and, per column in ``running``, ``cum_`` and ``total_``.

    ``order`` must end in a unique column. The sorted rows are made durable because the
    partition totals and the rows themselves are read separately and have to agree.
    """
    ordered = durable(
        df.orderBy(*order).withColumn(_AT, F.monotonically_increasing_id())
    ).withColumn(_PART, F.shiftright(_AT, _LOCAL_BITS))
    sums = {c: F.sum(c).alias(f"_{c}") for c in running}
    per_part = ordered.groupBy(_PART).agg(F.count("*").alias("_rows"), *sums.values())
    # One row per range partition: bounded by the number of shuffle partitions.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    overall = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shifts = per_part.select(
        _PART,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(overall).alias("total_rows"),
        *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}_before") for c in running],
        *[F.sum(f"_{c}").over(overall).alias(f"total_{c}") for c in running],
    )
    local = F.col(_AT).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    out = ordered.join(F.broadcast(shifts), _PART).withColumn(
        "row_num", F.col("_rows_before") + local + 1
    )
    if running:
        within = Window.partitionBy(_PART).orderBy(_AT).rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumns(
            {f"cum_{c}": F.col(f"_{c}_before") + F.sum(c).over(within) for c in running}
        )
    return out.drop(_PART, _AT, "_rows_before", *[f"_{c}_before" for c in running])


def tile(k: int, row_num: str = "row_num", total: str = "total_rows") -> Column:
    """The tile of NTILE(k) for a global row number: the first n mod k tiles get one more."""
    rn, n = F.col(row_num), F.col(total)
    size, extra = F.floor(n / k), n % k
    wide = extra * (size + 1)
    # With fewer rows than tiles, size is 0 and every row falls into the wide part.
    return (
        F.when(rn <= wide, F.floor((rn - 1) / (size + 1)) + 1)
        .otherwise(extra + F.floor((rn - 1 - wide) / F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )


def value_ranks(df: DataFrame, metrics: list[str], weights: dict[str, Column] | None = None):
    """Average-rank percentiles per distinct value of each metric, from one sort.

    Values are counted first, so the sort sees one row per (metric, value). All metrics
    share it: they cover the same rows, so the count in front of metric i is i x n.
    Returns rows (metric, value, n_equal, <weights>, avg_rank, total, pct_rank).
    """
    weights = weights or {}
    stacked = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("slot"), F.lit(m).alias("metric"),
                             F.col(m).cast("double").alias("value"))
                    for i, m in enumerate(metrics)
                ]
            )
        ).alias("m"),
        *[w.alias(name) for name, w in weights.items()],
    ).select("m.*", *weights)
    counted = (
        stacked.where("value is not null")
        .groupBy("slot", "metric", "value")
        .agg(F.count("*").alias("n_equal"), *[F.sum(name).alias(name) for name in weights])
    )
    ranked = numbered(counted, [F.col("slot"), F.col("value")], running=["n_equal"])
    total = (F.col("total_n_equal") / len(metrics)).cast("long")
    upto = F.col("cum_n_equal") - F.col("slot") * total
    # Ranks upto-n+1 .. upto are shared by n equal values; their mean is upto-(n-1)/2.
    avg_rank = upto - (F.col("n_equal") - 1) / 2.0
    return ranked.select(
        "metric", "value", "n_equal", *weights, avg_rank.alias("avg_rank"), total.alias("total")
    ).withColumn("pct_rank", F.col("avg_rank") / F.col("total"))


def percent_rank_average(df: DataFrame, metric: str, name: str = "pct_rank") -> DataFrame:
    """Attach the average-rank percentile of ``metric`` to every row (NULL stays NULL).

    The ranks have one row per value, so a value that many rows share is many rows on one side
    of the join only, and AQE can split them.
    """
    ranks = value_ranks(df, [metric]).select(F.col("value").alias("_value"), F.col("pct_rank").alias(name))
    return df.join(ranks, F.col(metric).cast("double") == F.col("_value"), "left").drop("_value")
