"""Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Spread a small file scan over all cores before costly per-row Python work.

    For plain scans only, where the partition count comes from file sizes. A
    large table has more splits than the cluster has cores and is not shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, key)
