"""Intermediate tables of the operators, in the folder all executors share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import CODEC, fresh_dir, freed_shuffles, passing, stored

ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
OTHER_NAMES = 1 << 62  # from here on, names are hashes and not ids
ARROW_BYTES = 4 << 20  # bytes of rows that a Python worker is sent at once; a longer row goes alone
SENT_ROWS = 500_000  # rows of a few numbers that a join may send through the driver, about 35 MB in its memory


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, after its session is told to send texts to Python in batches of ARROW_BYTES.

    The default is sixteen times that, and a worker holds a batch several times over, as does its
    executor. A limit that the user has set differs from the default and stays.
    """
    conf = docs.sparkSession.conf
    if conf.get(ARROW_LIMIT) == "67108864b":
        conf.set(ARROW_LIMIT, f"{ARROW_BYTES}b")
    return docs


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it from then on: lost executors cost a re-read, and later
    joins know its true size. The shuffle files of the write go with it."""
    with freed_shuffles(df.sparkSession):
        return stored(df, fresh_dir(df.sparkSession, f"llm-{name}"), CODEC)


def bounded(df: DataFrame, most: int | None = None) -> DataFrame:
    """``df``, a stored table; with over ``most`` rows (SENT_ROWS) joins move it and send it to no executor whole.

    Spark judges a table by its files, and a broadcast is built by the driver: an id takes
    56 bytes there and few in a compressed file, so that one below the threshold could fill the driver's memory.
    """
    return df if df.count() <= (SENT_ROWS if most is None else most) else df.hint("merge")


def distil(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """As ``keep``, of what ``make`` returns; the tables that ``make`` itself kept are then deleted,
    so that a chain of steps holds their results and not all that led to them."""
    path = fresh_dir(spark, f"llm-{name}")
    with passing(spark), freed_shuffles(spark):
        return stored(make(), path, CODEC)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int, column: str = "doc_id"):
    """crc32 of the id as text, modulo n; null ids count as remainder 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(0))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it while ``df`` has such a column (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_names(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the column ``name``: doc_id, but where an id has different texts, only for the
    one with the least hash; the others get a hash of id and text, from OTHER_NAMES on. Null without id.
    """
    key = F.xxhash64("doc_id", "text")
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id", key.alias("_key")).groupBy("doc_id").agg(F.min("_key").alias("_least"), F.max("_key").alias("_most"))
    several = keep(ids.where("_least < _most").select(F.col("doc_id").alias("_of"), "_least"), "ids-of-several-texts")
    if several.isEmpty():
        return docs.withColumn(name, F.col("doc_id"))
    joined = docs.join(several, docs["doc_id"] == several["_of"], "left")
    other = F.shiftrightunsigned(key, 2).bitwiseOR(F.lit(OTHER_NAMES))
    named = F.when(several["_least"].isNull() | (key == several["_least"]), docs["doc_id"]).otherwise(other)
    return joined.select(*[docs[c] for c in docs.columns], named.alias(name))


def one_row_per_id(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of those that share an id, the one with the least hash over all columns
    (maps aside), so that reruns agree; rows without id all stay.

    Only the rows of repeated ids are compared in full, so texts move only if there are any.
    """
    repeated = keep(docs.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(key), "repeated-ids")
    if repeated.isEmpty():
        return docs
    hashed = [docs[f.name] for f in docs.schema if "map<" not in f.dataType.simpleString()]
    one = docs.join(repeated, key, "left_semi").groupBy(F.col(key).alias("_of")).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*hashed)).alias("_row"))
    return docs.join(repeated, key, "left_anti").select(docs.columns).unionByName(one.select("_row.*"))
