"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Whole texts go to Python workers, so bound a batch by bytes, not rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}

_own_scratch: dict[str, str] = {}
#: Folder of each table that `materialize` wrote, by the frame that reads it.
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def session(app: str = "corpusmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session without that setting gets a folder of its own: on a
    cluster a machine-local folder would lose data with its machine.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = tempfile.mkdtemp(prefix="corpusmill-")
    return _own_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back.

    This cuts the lineage through durable files, so a lost executor costs a
    re-read and not a recomputation, and it gives later joins exact sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _written[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that `materialize` wrote, once nothing reads them any more.

    The shuffle files of finished steps go with them: Spark removes these when the
    driver's objects are collected, which a driver with idle memory puts off.
    """
    for table in tables:
        path = _written.pop(table, None)
        if path:
            jvm = table.sparkSession._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
    gc.collect()
    SparkSession.active()._jvm.System.gc()
