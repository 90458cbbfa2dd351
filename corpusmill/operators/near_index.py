"""A stored index of band keys, so that a grown corpus is deduplicated batch by batch.

A kept record removes every later record that shares one of its buckets, so no
two kept records share a bucket: the index has one row per bucket, eight per
kept record, and never a text. A new batch is decided against it and within
itself, which gives the same records as one run over all batches in order.

The index is a bucketed Parquet table: a batch's keys are shuffled to the index,
not the index to the batch. Rows count once their attempt is listed in `commits`,
which is written last; those of an attempt that broke off are never seen.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import dedupe as near
from corpusmill.runtime import materialize

BUCKETS = 64
_COMMITS = "number int, batch string, attempt string, buckets int, n_kept bigint"


class NearIndex:
    """The index at `path`, a folder all executors share; one writer at a time.

    `buckets` is how many files a batch has, and in how many parts it is joined;
    it is fixed by the first batch. A record's key is its `order` columns, the
    same ones for every batch.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        commits = self._commits().orderBy("number").collect()
        self.batches: list[str] = [row["batch"] for row in commits]
        self.buckets = commits[0]["buckets"] if commits else buckets
        self.table = "near_index_" + hashlib.md5(self.path.encode()).hexdigest()[:16]

    def _commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(_COMMITS).json(f"{self.path}/commits")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMITS)

    def rows(self) -> DataFrame:
        """(bucket, key, place, number, batch) of all committed batches; `place` is the order in the batch."""
        if not self.batches:
            raise ValueError(f"no batch has been committed to {self.path}")
        if not self.spark.catalog.tableExists(self.table):
            # The table is known to a catalog only in the session that made it.
            schema = self.spark.read.parquet(f"{self.path}/bands").schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(
                f"CREATE TABLE {self.table} ({columns}) USING parquet CLUSTERED BY (bucket) "
                f"SORTED BY (bucket) INTO {self.buckets} BUCKETS LOCATION '{self.path}/bands'"
            )
        self.spark.catalog.refreshTable(self.table)
        commits = F.broadcast(self._commits().select("attempt", "number", "batch"))  # a row per batch
        return self.spark.table(self.table).join(commits, "attempt").drop("attempt")

    def lookup(self, records: DataFrame, order: Sequence[str], text: str = "content") -> DataFrame:
        """`order` columns, `batch` and `key` of the earliest stored record that each is a candidate of.

        Records without one, and those too short to be signed, give no row.
        """
        banded = near.band_table(records, order, text)
        return self._matches(banded).join(banded, "__ord").select(*order, "batch", "key")

    def _matches(self, banded: DataFrame) -> DataFrame:
        found = near.band_members(banded).join(self.rows(), "bucket").groupBy("__ord")
        first = found.agg(F.min(F.struct("number", "place", "batch", "key")).alias("first"))
        return first.select("__ord", "first.batch", "first.key")

    def insert(
        self,
        records: DataFrame,
        order: Sequence[str],
        batch: str,
        text: str = "content",
        hot_rows: int = near.HOT_ROWS,
        walk_rows: int = near.WALK_ROWS,
    ) -> DataFrame:
        """The records of a new batch to keep; their band keys join the index.

        They come after all earlier batches, and within the batch in `order`. A
        batch that is committed already is not inserted again: given the same
        records, the same ones are kept.
        """
        if batch in self.batches:
            known = self.rows().filter(F.col("batch") == batch).select("key.*").distinct()
            return near.long_enough(records, text).join(known, list(order), "left_semi")
        banded = near.band_table(records, order, text)
        fresh = banded
        if self.batches:
            old = materialize(self._matches(banded).select("__ord"), "in-index")
            fresh = banded.join(old, "__ord", "left_anti")
        kept = materialize(near.survivors(fresh, hot_rows, walk_rows), "kept")
        self._append(banded.join(kept, "__ord", "left_semi"), order, batch)
        removed = materialize(banded.join(kept, "__ord", "left_anti").select(*order), "near-duplicates")
        return near.long_enough(records, text).join(removed, list(order), "left_anti")

    def _append(self, kept: DataFrame, order: Sequence[str], batch: str) -> None:
        attempt = uuid.uuid4().hex
        key = F.struct(*order).alias("key")
        rows = kept.select("__ord", key, F.explode(near.each_band_key(F.col("__bands"))).alias("bucket"))
        rows = rows.select("bucket", "key", F.col("__ord").alias("place"), F.lit(attempt).alias("attempt"))
        if self.batches:
            self.rows()  # makes the table known
        (
            rows.repartition(self.buckets, "bucket")
            .write.mode("append")
            .bucketBy(self.buckets, "bucket")
            .sortBy("bucket")
            .option("path", f"{self.path}/bands")
            .saveAsTable(self.table)
        )
        commit = (len(self.batches), batch, attempt, self.buckets, kept.count())
        self.spark.createDataFrame([commit], _COMMITS).coalesce(1).write.mode("append").json(f"{self.path}/commits")
        self.batches.append(batch)

    def close(self) -> None:
        """Forget the table; the files at `path` stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
