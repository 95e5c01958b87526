"""Ingest of JSON lines whose keys change: what the schema does not hold is kept beside it, and told.

A line's known keys become typed columns. Keys that the schema does not have, and values that do not fit their column,
are kept in `rescued`, a VARIANT object; a line that is no JSON object is kept there whole, under ``_line``. A log tells
which keys were rescued with which types, by batch, so that the schema can be widened and the rows read again from
`rescued`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from furlong.operators.stage import compute_once
from furlong.streaming.files import BATCH_BYTES, for_each_batch

RESCUED, LINE = "rescued", "_line"
LOG = "batch_id long, key string, type string, n long"


def read_lines(spark: SparkSession, root: str, partitions: T.StructType | None = None) -> DataFrame:
    """A folder tree of text files as a stream of lines in ``value``; partition folders become columns."""
    schema = T.StructType([T.StructField("value", T.StringType()), *(partitions or T.StructType()).fields])
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", BATCH_BYTES).text(root)


def rescue(lines: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns to keep, the columns of the schema, and ``rescued``: NULL where a line fits. A null value fits any column."""
    fields = {f.name: f.dataType.simpleString() for f in schema.fields}
    parsed = compute_once(lines, (*keep, "value"), {"_keys": F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>")})

    def left_over(key: Column, value: Column) -> Column:
        fits = F.lit(False)
        for name, kind in fields.items():
            fits = F.when(key == name, F.is_variant_null(value) | F.try_variant_get(value, "$", kind).isNotNull()).otherwise(fits)
        return ~fits

    over = F.coalesce(F.map_filter("_keys", left_over), F.create_map(F.lit(LINE), F.expr("CAST(value AS VARIANT)")))
    typed = [F.try_variant_get(F.element_at("_keys", F.lit(name)), "$", kind).alias(name) for name, kind in fields.items()]
    return parsed.select(*keep, *typed, F.when(F.size(over) > 0, F.to_variant_object(over)).alias(RESCUED))


def rescued_keys(rows: DataFrame) -> DataFrame:
    """`key`, `type`, `n`: what `rescued` holds, counted in the map tasks."""
    entries = rows.select(F.explode(F.variant_get(RESCUED, "$", "map<string,variant>")).alias("key", "held"))
    return entries.groupBy("key", F.schema_of_variant("held").alias("type")).agg(F.count(F.lit(1)).alias("n"))


def ingest_rescued(
    lines: DataFrame, schema: T.StructType, table: str, log: str, checkpoint: str, keep: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append lines to a parquet folder, rescued parts with them, and the keys rescued to the log.

    A batch that is run again replaces its own folders. The log is made from what the batch has stored.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{table}/batch_id={batch_id}"
        rows = rescue(batch, schema, keep)
        rows.write.mode("overwrite").parquet(folder)
        stored = batch.sparkSession.read.schema(rows.schema).parquet(folder)
        rescued_keys(stored).withColumn("batch_id", F.lit(batch_id).cast("long")).coalesce(1).write.mode("overwrite").json(f"{log}/part={batch_id}")

    return for_each_batch(lines, write, checkpoint)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(LOG).json(log).select("batch_id", "key", "type", "n")
