"""Recursive scan of source and documentation files.

Folders are listed level by level in tasks, and files are read in partitions of
even bytes, so no list of names passes through the driver, and hidden names,
empty files and the path below the root come out as they are. A folder or file
that cannot be read is a row with a reason, which `skipped_files` shows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.fixed_values import CODE_EXTENSIONS, DOC_EXTENSIONS
from corpusmill.runtime import materialize
from corpusmill.sources.planned_files import (
    MAX_FILE_BYTES, SPLIT_BYTES, open_store, plan_reads, read_planned, reason_of,
)

EXTENSIONS = CODE_EXTENSIONS + DOC_EXTENSIONS

#: Names that a task holds while it lists a folder of this machine.
PIECE_ROWS = 10_000
_LISTED = "path string, is_folder boolean, n_bytes bigint, reason string, error string"

_REPLACEMENT = "\ufffd"
# Before bad bytes become U+FFFD and go, a genuine one is written as ESCAPE 1 and
# a genuine ESCAPE as ESCAPE 0.
_ESCAPE = "\ufdd0"


def decode_ignoring_errors(content: Column) -> Column:
    """Bytes to text: bad UTF-8 dropped, line ends normalised to a line feed."""
    text = content.cast("string")
    safe = F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "0"))
    safe = F.replace(safe, F.lit(_REPLACEMENT), F.lit(_ESCAPE + "1"))
    safe = F.replace(F.make_valid_utf8(safe), F.lit(_REPLACEMENT), F.lit(""))
    safe = F.replace(safe, F.lit(_ESCAPE + "1"), F.lit(_REPLACEMENT))
    safe = F.replace(safe, F.lit(_ESCAPE + "0"), F.lit(_ESCAPE))
    return F.regexp_replace(F.when(F.is_valid_utf8(text), text).otherwise(safe), "\r\n?", "\n")


def with_extension(files: DataFrame) -> DataFrame:
    """Add `ext` and its rank, the first part of the record order."""
    ext = F.regexp_extract("path", r"\.([^./]+)$", 1)
    rank = F.array_position(F.array(*[F.lit(e) for e in EXTENSIONS]), F.col("ext")) - 1
    return files.withColumn("ext", ext).withColumn("ext_rank", rank.cast("int"))


def fs_absolute(root: str) -> str:
    """A plain path of this machine as an absolute one; others as they are."""
    return root if "://" in root or root.startswith("file:") else os.path.abspath(root)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, is_folder, n_bytes, reason, error) of everything under `root`, paths relative to it.

    Links to folders are not followed; a link that leads nowhere is a file without a size.
    """
    root = fs_absolute(root)

    def entries(store: fs.FileSystem, place: str) -> Iterator[tuple[str, bool, int | None]]:
        if not isinstance(store, fs.LocalFileSystem):
            for info in store.get_file_info(fs.FileSelector(place)):
                yield info.base_name, info.type == fs.FileType.Directory, info.size
            return
        with os.scandir(place) as found:
            for entry in found:
                if entry.is_dir(follow_symlinks=False):
                    yield entry.name, True, None
                elif not entry.is_dir():
                    yield entry.name, False, entry.stat().st_size if os.path.exists(entry.path) else None

    def children(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = open_store(root)
        columns = ["path", "is_folder", "n_bytes", "reason", "error"]
        for batch in batches:
            rows = []
            for folder in batch["path"]:
                try:
                    for name, is_folder, size in entries(store, f"{base}/{folder}".rstrip("/") or "/"):
                        rows.append((f"{folder}/{name}" if folder else name, is_folder, size, None, None))
                        if len(rows) == PIECE_ROWS:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                except OSError as error:
                    rows.append((folder, False, None, reason_of(error), str(error)))
            yield pd.DataFrame(rows, columns=columns)

    level = spark.createDataFrame([("",)], "path string")
    levels = []
    while True:
        found = materialize(level.mapInPandas(children, _LISTED), "listing")
        levels.append(found)
        level = found.filter("is_folder").select("path")
        if level.isEmpty():
            return reduce(DataFrame.union, levels)
        cores = spark.sparkContext.defaultParallelism
        level = level.repartition(cores, "path")


def found_files(listing: DataFrame) -> DataFrame:
    """(path, ext, ext_rank, n_bytes) of the files of known extensions, without their content."""
    files = with_extension(listing.filter("not is_folder and reason is null"))
    return files.filter("ext_rank >= 0").select("path", "ext", "ext_rank", "n_bytes")


def read_files(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    split_bytes: int = SPLIT_BYTES,
    max_bytes: int = MAX_FILE_BYTES,
) -> DataFrame:
    """`files` with `data`, their bytes, or a `reason` and an `error` where they cannot be read."""
    return read_planned(spark, fs_absolute(root), plan_reads(files, split_bytes, max_bytes), max_bytes)


def scan_corpus(spark: SparkSession, root: str, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Files under `root` with a path relative to it; unreadable ones are skipped."""
    files = read_files(spark, root, found_files(list_files(spark, root)), max_bytes=max_bytes)
    content = decode_ignoring_errors(F.col("data")).alias("content")
    return files.filter("reason is null").select("path", "ext", "ext_rank", "n_bytes", content)


def skipped_files(spark: SparkSession, root: str, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """(path, reason, error) of folders and files under `root` that cannot be read or are too large."""
    listing = list_files(spark, root)
    told = ["path", "reason", "error"]
    unread = read_files(spark, root, found_files(listing), max_bytes=max_bytes).filter("reason is not null")
    return listing.filter("reason is not null").select(*told).union(unread.select(*told))


def scan_report(spark: SparkSession, root: str, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Per extension: files found, bytes, files holding invalid UTF-8, and those that are skipped."""
    files = read_files(spark, root, found_files(list_files(spark, root)), max_bytes=max_bytes)
    return files.groupBy("ext").agg(
        F.count("*").alias("n_files"),
        F.sum("n_bytes").alias("n_bytes"),
        F.count_if(~F.is_valid_utf8(F.col("data").cast("string"))).alias("n_invalid_text"),
        F.count("reason").alias("n_skipped"),
    )


def repo_of(path: Column) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(1))


def repo_sizes(files: DataFrame) -> DataFrame:
    """Bytes and file count per repository (the first path part).

    `found_files` is enough: sizes come from the listing, no content is read.
    """
    return files.groupBy(repo_of(F.col("path")).alias("repository")).agg(
        F.count("*").alias("n_files"),
        F.sum("n_bytes").alias("n_bytes"),
    )


def provenance_gap(files: DataFrame, sources: DataFrame) -> DataFrame:
    """Repositories with files but no provenance row.

    Files collapse to one row per repository before the join.
    """
    return repo_sizes(files).join(sources.select("repository"), "repository", "left_anti")
