"""Seeds, source tables, and models as views or tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.schemas import LOADED_AT, SHOP_RAW


def raw_schema(target_schema: str) -> str:
    """Schema that holds the raw tables of a target."""
    return f"{target_schema}_raw"


def load_seed(
    spark: SparkSession, path: str, name: str, target_schema: str, location: str | None = None
) -> DataFrame:
    """Load a CSV seed (with header) into ``<target_schema>_raw.<name>``; types are declared, not guessed.

    ``location`` is the folder of the raw schema; without it the warehouse folder is used.
    """
    df = spark.read.schema(SHOP_RAW[name]).option("header", True).csv(path)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {raw_schema(target_schema)}{where}")
    return as_table(df, f"{raw_schema(target_schema)}.{name}", f"{location}/{name}" if location else None)


def source(spark: SparkSession, target_schema: str, name: str) -> DataFrame:
    """One of the declared raw tables."""
    if name not in SHOP_RAW:
        raise KeyError(f"no such source table: {name}")
    return spark.table(f"{raw_schema(target_schema)}.{name}")


def catalog_table(spark: SparkSession, catalog: str, schema: str, name: str) -> DataFrame:
    return spark.table(f"`{catalog}`.`{schema}`.`{name}`")


def freshness(df: DataFrame, name: str, loaded_at: str | None = None) -> DataFrame:
    """Newest load time of a raw table. One aggregate over one column."""
    column = loaded_at or LOADED_AT[name]
    return df.agg(F.lit(name).alias("source_name"), F.max(column).alias("max_loaded_at"))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a model as a view: nothing is stored, the planner sees through it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(
    df: DataFrame, name: str, location: str | None = None, partition_by: tuple[str, ...] = (),
    bucket_by: tuple[int, str] | None = None,
) -> DataFrame:
    """Store a model as a parquet table, replacing its rows, and return the stored table.

    ``bucket_by`` (count, column) stores it hashed on a join key, so that later joins on that
    key need no shuffle of it.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", location)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        count, column = bucket_by
        writer = writer.bucketBy(count, column).sortBy(column)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    """Tables of a schema, from the catalog."""
    return spark.sql(f"SHOW TABLES IN {schema}").where(~F.col("isTemporary")).select(
        F.col("tableName").alias("table_name")
    )


def list_columns(spark: SparkSession, table: str) -> DataFrame:
    """Columns of a table and their types, in order."""
    rows = [(i, c.name, c.dataType) for i, c in enumerate(spark.catalog.listColumns(table), 1)]
    return spark.createDataFrame(rows, "ordinal_position int, column_name string, data_type string")
