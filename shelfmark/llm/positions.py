"""Gapless positions of rows inside their group, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.storage import keep

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def with_positions(rows: DataFrame, group: str, order: list[Column], into: str, total: str | None = None) -> DataFrame:
    """``rows`` with ``into``: 0, 1, ... inside each value of ``group`` (null is a value too), by
    ``order``; rows equal in that keep the order they are read in. ``total``: a column for the
    number of rows of the group.

    The rows are stored, as a range sort reads its input twice. One sort by group and order deals
    even a group of all rows over the tasks, as the row's place in the input is the last sort key.
    The sorted rows are stored with their place in their task; the position is that place, less
    the group's first place there, plus the group's rows in earlier tasks. Only one row for each
    task and group is ever brought together. ``rows`` must hold no column whose name begins with
    ``_at``.
    """
    row = F.monotonically_increasing_id()
    sorted_ = keep(rows, "to-sort").withColumn("_at_row", row).orderBy(F.col(group).asc_nulls_first(), *order, "_at_row").drop("_at_row")
    at = keep(sorted_.withColumn("_at", row), "sorted")
    task, place = F.shiftrightunsigned("_at", _LOCAL_BITS), F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    # a group begins in a task at its least place there; a task holds few groups, or they are small
    runs = at.groupBy(task.alias("_at_task"), F.col(group).alias("_at_group")).agg(F.min(place).alias("_at_first"), F.count("*").alias("_at_n"))
    earlier = Window.partitionBy("_at_group").orderBy("_at_task").rowsBetween(Window.unboundedPreceding, -1)  # rows: one per task
    runs = keep(runs.withColumn("_at_shift", F.coalesce(F.sum("_at_n").over(earlier), F.lit(0)) - F.col("_at_first"))
                .withColumn("_at_total", F.sum("_at_n").over(Window.partitionBy("_at_group"))).drop("_at_n", "_at_first"), "runs")
    same = (task == runs["_at_task"]) & at[group].eqNullSafe(runs["_at_group"])
    return at.join(runs, same).select(*[at[c] for c in rows.columns], (place + runs["_at_shift"]).cast("long").alias(into), *([runs["_at_total"].alias(total)] if total else []))
