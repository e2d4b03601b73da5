"""Sinks: files, catalog tables, JDBC, audit log, models and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfmark.operators.validate import union_all
from shelfmark.session import CODEC, freed_shuffles
from shelfmark.sources.adapter import Tables


def escaped(c: str) -> Column:
    """Text without line breaks: they become \\n and \\r, and a backslash becomes two."""
    doubled = F.replace(F.col(c), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def write_csv(df: DataFrame, path: str, codec: str | None = None) -> str:
    """CSV of one line per row, with doubled quotes and untouched blanks.

    Line breaks are escaped, so files can be split at any line; ``readers.read_csv`` undoes it.
    NULL is an empty field, empty text a pair of quotes.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    writer = df.withColumns({c: escaped(c) for c in texts}).write.mode("overwrite")
    if codec is not None:
        writer = writer.option("compression", codec)
    (
        writer.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def save_processed_files(
    valid: Tables, rejected: DataFrame, audit: DataFrame, out_dir: str
) -> dict[str, str]:
    """Three clean tables, the dead letters and the audit summary, overwritten."""
    paths = {
        name: write_csv(df, f"{out_dir}/{name}_clean.csv") for name, df in valid.items().items()
    }
    paths["rejected_records"] = write_csv(rejected, f"{out_dir}/rejected_records.csv")
    paths["audit_summary"] = write_json(audit, f"{out_dir}/etl_audit_summary.json")
    return paths


def save_table(
    df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite", codec: str | None = None
) -> str:
    """Parquet catalog table; ``path`` makes it external."""
    writer = df.write.mode(mode).format("parquet")
    if codec is not None:
        writer = writer.option("compression", codec)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def load_tables(
    tables: dict[str, DataFrame], prefix: str = "", out_dir: str | None = None, codec: str | None = None
) -> DataFrame:
    """Replace the given tables; returns rows loaded per table, counted on what was written."""
    loaded = []
    for name, df in tables.items():
        target = save_table(df, f"{prefix}{name}", f"{out_dir}/{name}" if out_dir else None, codec=codec)
        loaded.append(
            df.sparkSession.table(target)
            .agg(F.count("*").alias("rows_loaded"))
            .select(F.lit(name).alias("table_name"), "rows_loaded")
        )
    return union_all(loaded)


def append_audit_row(row: DataFrame, name: str, path: str | None = None) -> str:
    """One more run in the audit log; earlier runs stay."""
    return save_table(row, name, path, mode="append")


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "overwrite", batch_size: int = 10000,
    **options: str,
) -> None:
    """Parallel batched inserts into an external database."""
    (
        df.write.mode(mode)
        .format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(batch_size), **options)
        .save()
    )


def export_star(
    star: dict[str, DataFrame], csv_dir: str, prefix: str = "pbi_", table_dir: str | None = None
) -> DataFrame:
    """Five CSV datasets and five catalog tables; returns the rows loaded per table.

    The datasets are written from the tables, so that each is computed once. Both are compressed, the
    CSV files with gzip: the order fact is many times the size of its source as plain text.
    """
    with freed_shuffles(next(iter(star.values())).sparkSession):
        loaded = load_tables(star, prefix, table_dir, CODEC)
    for name, df in star.items():
        write_csv(df.sparkSession.table(f"{prefix}{name}"), f"{csv_dir}/{name}.csv", "gzip")
    return loaded


def create_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def list_tables(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Catalog tables with their row counts; only the names pass through the driver."""
    names = sorted(
        t.name for t in spark.catalog.listTables() if not t.isTemporary and
        t.name.startswith(prefix)
    )
    if not names:
        return spark.createDataFrame([], "table_name string, row_count long")
    return union_all(
        [
            spark.table(n).agg(F.count("*").alias("row_count")).select(
                F.lit(n).alias("table_name"), "row_count"
            )
            for n in names
        ]
    )
