"""Catalog tables: one writer for every layer, and schema housekeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """Write ``df`` as the table ``schema.table``, creating the schema if needed.

    With a ``location`` the table is external and its files live there.
    """
    namespace = name.rpartition(".")[0]
    if namespace:
        create_schema(df.sparkSession, namespace)
    writer = df.write.mode(mode).format(fmt)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


RUN = "run_id"


def save_run(
    df: DataFrame, name: str, run_id: str, fmt: str = "parquet", location: str | None = None
) -> None:
    """Write ``df`` as the rows of one run in a table that is partitioned by run.

    Saving a run again replaces its rows and no others, so a repeated append is the same
    as one.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        namespace = name.rpartition(".")[0]
        if namespace:
            create_schema(spark, namespace)
        create_table(spark, name, df.schema, fmt, location)
    columns = [column for column in spark.table(name).columns if column != RUN]
    if RUN not in spark.table(name).columns or set(columns) != set(df.columns):
        raise ValueError(f"{name} has the columns {', '.join(columns)}; it is not a table of such runs")
    spark.sql(
        f"INSERT OVERWRITE TABLE {_quoted(name)} PARTITION ({RUN} = {_text(run_id)}) SELECT * FROM {{rows}}",
        rows=df.select(*columns),
    )


def create_table(
    spark: SparkSession, name: str, schema: StructType, fmt: str, location: str | None
) -> None:
    """An empty table partitioned by run."""
    empty = spark.createDataFrame([], schema).withColumn(RUN, F.lit(""))
    writer = empty.write.format(fmt).partitionBy(RUN)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def remove_run(spark: SparkSession, name: str, run_id: str) -> None:
    """Delete the rows of one run, if there is such a table with such a run."""
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {_quoted(name)} DROP IF EXISTS PARTITION ({RUN} = {_text(run_id)})")


def create_schema(
    spark: SparkSession, name: str, location: str | None = None
) -> None:
    """Create the schema unless it exists, optionally outside the warehouse."""
    if location is None:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(name)}")
    else:
        spark.sql(
            f"CREATE SCHEMA IF NOT EXISTS {_quoted(name)} LOCATION {_text(location)}"
        )


def use_catalog(spark: SparkSession, name: str) -> None:
    """Resolve unqualified schemas in the given catalog from here on."""
    spark.catalog.setCurrentCatalog(name)


def drop_schemas(spark: SparkSession, *names: str) -> None:
    """Drop the named schemas with all their tables. No pipeline step does this."""
    for name in names:
        spark.sql(f"DROP SCHEMA IF EXISTS {_quoted(name)} CASCADE")


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
