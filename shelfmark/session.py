"""Session defaults and lineage cutting."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def build_session(app_name: str = "shelfmark", **conf: str) -> SparkSession:
    """A session with the settings this library relies on; extra settings win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


PARTITIONS = "spark.sql.shuffle.partitions"
READ_TASKS = "spark.sql.files.minPartitionNum"
TASK_ROWS = 500_000  # order lines of a bucket or shuffle partition, so that a task sorts them in memory
CODEC = "zstd"  # of the raw and checked tables, which are the largest, and of the operators' tables


def parts_for(spark: SparkSession, rows: int) -> int:
    """The session's number of shuffle partitions, or more where these would hold over TASK_ROWS rows each."""
    return max(int(spark.conf.get(PARTITIONS)), -(-rows // TASK_ROWS))


@contextmanager
def wide_shuffles(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside shuffle into ``parts_for`` partitions, so that what a task sorts does not grow
    with the input, and read files in as many tasks, so that the last ones do not keep most cores
    waiting. Spark merges small ones again; the session's own numbers are put back."""
    before, tasks = spark.conf.get(PARTITIONS), spark.conf.get(READ_TASKS, None)
    spark.conf.set(PARTITIONS, str(parts_for(spark, rows)))
    spark.conf.set(READ_TASKS, str(max(int(tasks or 0), parts_for(spark, rows), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, before)
        spark.conf.set(READ_TASKS, tasks) if tasks else spark.conf.unset(READ_TASKS)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of jobs run inside are deleted when the job ends. By default they stay until the
    driver happens to collect its garbage, so a chain of jobs would hold those of all at once."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting it is a folder in the warehouse, which executors share as well; on a cluster
    a warehouse on a local disk is refused, as every machine would write to its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not sc.master.partition("[")[0] == "local" and _hadoop(spark, warehouse)[0].getScheme() == "file":
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share: {warehouse} is on a local disk")
        sc.setCheckpointDir(f"{warehouse}/shelfmark-work")
    return sc.getCheckpointDir().rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Materialise once on shared storage, so that a lost executor costs a re-read only.

    Used where two parts of one plan must see exactly the same physical row order, or
    where an iterative algorithm would otherwise replay its whole input per pass.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as that knows it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


_MADE: dict[str, list[str]] = {}  # folders by application
_TABLES: dict[str, list[str]] = {}  # bucketed tables by application
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)  # folders of the innermost ``passing``


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_dir(spark)}/shelfmark-{name}-{uuid.uuid4().hex[:12]}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    if (inside := _PASSING.get()) is not None:
        inside.append(path)
    return path


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Folders that this thread makes inside by ``fresh_dir`` are deleted at the end, so nothing lazy
    that reads them may leave. After an error they stay until ``cleanup``."""
    inside: list[str] = []
    outer = _PASSING.set(inside)
    try:
        yield
    finally:
        _PASSING.reset(outer)
    made = _MADE.get(spark.sparkContext.applicationId, [])
    for path in inside:
        files, at = _hadoop(spark, path)
        files.delete(at, True)
        if path in made:
            made.remove(path)


def cleanup(spark: SparkSession) -> int:
    """Delete the intermediate tables of this application, once no result of it is read any more.

    Returns the number of folders deleted. Results that the caller has written elsewhere stay.
    """
    app, deleted = spark.sparkContext.applicationId, 0
    for name in _TABLES.pop(app, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    for path in _MADE.pop(app, []):
        files, at = _hadoop(spark, path)
        deleted += bool(files.delete(at, True))
    return deleted


def stored_split(
    df: DataFrame, path: str, by: list[str], buckets: tuple[int, str] | None = None, more: Sequence[DataFrame] = ()
) -> DataFrame:
    """Write a table once, one directory for each value of ``by``, and read it from then on.

    Filters on ``by`` open only the directories that match. With ``buckets`` (number, column) rows are
    dealt by that column's hash, and joins and sums by it need no exchange. ``more`` are further shares
    of the table, which are added one after the other.
    """
    spark, name = df.sparkSession, f"shelfmark_{uuid.uuid4().hex}"
    if buckets is not None:
        _TABLES.setdefault(spark.sparkContext.applicationId, []).append(name)
    for share, mode in zip((df, *more), ("overwrite", *("append" for _ in more))):
        writer = share.write.mode(mode).partitionBy(*by).format("parquet").option("compression", CODEC)
        if buckets is None:
            writer.save(path)
        else:
            writer.bucketBy(*buckets).option("path", path).saveAsTable(name)
    return spark.read.schema(df.schema).parquet(path) if buckets is None else spark.table(name)


def stored_counted(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """As ``stored``, with the number of rows, counted by the writing stage."""
    seen = Observation()
    table = stored(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return table, seen.get["rows"]


def stored(df: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    """Write a table once and read it from then on.

    Unlike a checkpoint the copy is columnar: later plans read only the columns and row
    groups they need, and know its true size when they choose a join.
    """
    df.write.mode("overwrite").parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
