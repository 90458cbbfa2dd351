"""JSON-Lines tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from corpusmill.sources.publish import exists, publish


def read_records(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Fields a record lacks become null; unknown fields are not read.

    A line that is no record stops the read, rather than to count as a record of
    nulls.
    """
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_records(
    records: DataFrame, path: str, *partition_by: str, keep_others: bool = False
) -> None:
    """Replace the table at `path` once the new one is whole; null fields are written out.

    With `keep_others` only the partitions that `records` holds are replaced.
    """

    def write(place: str) -> None:
        writer = records.write.option("ignoreNullFields", "false")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.json(place)

    publish(records.sparkSession, path, write, per_partition=keep_others)


def read_optional(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table if it exists and has a row, else None (e.g. no validation split)."""
    if not exists(spark, path):
        return None
    table = read_records(spark, path, schema)
    return None if table.isEmpty() else table
