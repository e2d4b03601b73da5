"""Typed readers. Nothing is inferred, nothing is collected."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfmark import schemas
from shelfmark.session import fresh_dir, stored_counted
from shelfmark.sources.adapter import Tables


class RawDataExtractionError(Exception):
    """A raw source is missing or cannot be read with its schema."""


def unescaped(c: str) -> Column:
    """Text as it was before ``writers.escaped``.

    Every backslash begins a pair. Cutting at the pairs that stand for a backslash leaves only
    line breaks to put back, whatever text surrounds them.
    """
    part = F.transform(
        F.split(c, r"\\\\"), lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    )
    return F.when(F.contains(F.col(c), F.lit("\\")), F.array_join(part, "\\")).otherwise(F.col(c))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, foreign: bool = False
) -> DataFrame:
    """CSV with a header and a fixed schema; a malformed line fails the job.

    Files of ``writers.write_csv`` hold one row per line and can be split anywhere. Those of
    others (``foreign``) may hold line breaks in quotes: each is read by one task, as it is.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", foreign)
        .option("escape", '"')
    )
    if not foreign:
        # a pair that no escaped text holds: empty fields are NULL, quoted empty text stays text
        reader = reader.option("nullValue", "\\-")
    rows = reader.csv(path)
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return rows if foreign else rows.withColumns({c: unescaped(c) for c in texts})


def with_input_order(df: DataFrame) -> DataFrame:
    """Add ``src_seq``: position by file, block and row, fixed by materialising it once.

    Needed for keep-first rules. Row ids depend on how files are split, so they must not be
    derived a second time by another branch of the plan. The copy is columnar.
    """
    return _ordered(df)[0]


def _ordered(df: DataFrame) -> tuple[DataFrame, int]:
    meta = F.col("_metadata")
    numbered = df.select(
        "*",
        F.struct(
            meta["file_path"].alias("file"),
            meta["file_block_start"].alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("src_seq"),
    )
    return stored_counted(numbered, fresh_dir(df.sparkSession, "extracted"))


def extract_raw_table(
    spark: SparkSession, path: str, table: str, schema: T.StructType | None = None,
    foreign: bool = True,
) -> DataFrame:
    """One raw CSV source in input order; any failure becomes RawDataExtractionError."""
    return extract_counted(spark, path, table, schema, foreign)[0]


def extract_counted(
    spark: SparkSession, path: str, table: str, schema: T.StructType | None = None,
    foreign: bool = True,
) -> tuple[DataFrame, int]:
    """As ``extract_raw_table``, with the rows counted while they are stored."""
    try:
        return _ordered(read_csv(spark, path, schema or schemas.RAW[table], foreign))
    except AnalysisException as err:
        raise RawDataExtractionError(f"source of {table!r} not readable at {path}") from err
    except Exception as err:  # a malformed line surfaces while the rows are materialised
        raise RawDataExtractionError(f"failed to parse {table!r} from {path}") from err


def extract_all(
    spark: SparkSession, raw_dir: str, extracted_at: str, foreign: bool = True
) -> tuple[Tables, DataFrame]:
    """The three raw tables and one metadata row with their counts, in one pass over each."""
    found = {t: extract_counted(spark, f"{raw_dir}/{t}.csv", t, None, foreign) for t in schemas.RAW}
    tables = Tables(**{t: df for t, (df, _) in found.items()})
    counts = [F.lit(n).cast("long").alias(t) for t, (_, n) in found.items()]
    metadata = spark.range(1).select(
        F.lit(extracted_at).cast("timestamp").alias("extracted_at"),
        F.lit(raw_dir).alias("raw_directory"),
        F.struct(*counts).alias("source_counts"),
    )
    return tables, metadata


def load_cleaned(spark: SparkSession, path: str | None = None, prefix: str = "") -> Tables:
    """The validated tables from files if they are there, else from the table store."""
    names = ("customers", "products", "orders")
    if path is not None:
        try:
            return Tables(
                *[read_csv(spark, f"{path}/{n}_clean.csv", schemas.CLEAN[n]) for n in names]
            )
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
    return Tables(*[spark.table(f"{prefix}{n}") for n in names])


def execute_query(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)


def read_star(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The exported star schema with the column types of its writer."""
    return {name: read_csv(spark, f"{path}/{name}.csv", s) for name, s in schemas.STAR.items()}


def read_audit_summary(spark: SparkSession, path: str) -> DataFrame:
    """The audit summary as nested columns, maps included."""
    return (
        spark.read.schema(schemas.AUDIT).option("mode", "FAILFAST").json(f"{path}/etl_audit_summary.json")
    )


def parsed_audit_log(log: DataFrame) -> DataFrame:
    """The audit log with ``audit``: its JSON text as the same nested columns."""
    return log.withColumn("audit", F.from_json("audit_json", schemas.AUDIT, {"mode": "FAILFAST"}))


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, f"{path}/rejected_records.csv", schemas.REJECTED)
