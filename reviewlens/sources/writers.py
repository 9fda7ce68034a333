"""Parquet sinks: overwrite, balanced files, partition refresh, shared results."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions.dates import epoch_to_date, month_start
from reviewlens.schemas import MONTH
from reviewlens.sources import files

MB = 1024 * 1024
MAX_FILE_BYTES = 100 * MB
TARGET_FILE_BYTES = 90 * MB
# Bytes of rows in an exchange that become one byte of Parquet, about.
SHUFFLED_PER_STORED = 1.3
# How often a stored copy is arranged again, at most.
ARRANGEMENTS = 3
# A task's part of a table whose files are smaller than that, in bytes of Parquet, and
# how many files it may write.
TASK_BYTES = 64 * MB
TASK_FILES = 128
STEP = "__"


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _write_files(df: DataFrame, path: str, tasks: int, rows: int) -> None:
    """Deal rows evenly to tasks, each of which writes files of ``rows`` rows.

    Tasks move their files into place themselves, where the driver would move one after
    the other; ``path`` must be a folder that nothing reads before the job has ended.
    """
    df.repartition(tasks).write.mode("overwrite").options(
        maxRecordsPerFile=rows, **{"mapreduce.fileoutputcommitter.algorithm.version": 2}
    ).parquet(path)


@contextmanager
def _advised(spark: SparkSession, size: int) -> Iterator[None]:
    """Adaptive execution makes partitions of about ``size`` bytes inside the block."""
    wanted = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{size}b",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write_balanced(
    df: DataFrame,
    path: str,
    max_bytes: int = MAX_FILE_BYTES,
    target_bytes: int = TARGET_FILE_BYTES,
    order: Sequence[Column] = (),
) -> int:
    """Write a table as files of about ``target_bytes``; returns the number of files.

    A table of at most ``max_bytes`` is one file, a larger one has files of at most
    that size and about equal parts.  The frame is computed once and normally written
    once: a rebalancing exchange knows the real size of the data and cuts them into
    parts that become files of about the target size; with ``order``, which is the
    order of the rows in the files, one file after the other, the exchange is the one
    of the sort.  Only where the compressed files turn out too large, or much too many,
    the stored copy is arranged again.  Small files, without ``order``, are always written
    from a stored copy, many by each task: their size is found by writing one task's part.

    The old table is moved aside when the new one is complete and deleted after the
    new one is in place.  If that fails, the old table is put back and what was staged
    is removed; after a crash in between, :func:`recover` does so from the names.
    """
    spark = df.sparkSession
    recover(spark, path)
    mark = uuid.uuid4().hex[:8]
    staging, ready, old = (f"{path}{STEP}{step}_{mark}" for step in ("staging", "ready", "old"))
    try:
        part_bytes = target_bytes if order else max(target_bytes, TASK_BYTES)
        with _advised(spark, int(part_bytes * SHUFFLED_PER_STORED)):
            write_table(df.orderBy(*order) if order else df.hint("rebalance"), staging)
        sizes = files.data_files(spark, staging)
        total = sum(sizes)
        wanted = 1 if total <= max_bytes else math.ceil(total / target_bytes)
        if fits(sizes, wanted, max_bytes):
            files.rename(spark, staging, ready)
        else:
            stored = spark.read.schema(df.schema).parquet(staging)
            rows, dealers = (0, 0) if order or wanted == 1 else (stored.count(), len(sizes))
            if rows:
                wanted = _probed(stored, f"{ready}_probe", rows, total, wanted, dealers, target_bytes)
            for _ in range(ARRANGEMENTS):
                # One file only when the measured size is at most max_bytes.
                if rows:
                    _write_files(stored, ready, *_dealt(rows, total, wanted, dealers))
                elif wanted == 1:
                    write_table(stored.coalesce(1).sortWithinPartitions(*order) if order else stored.coalesce(1), ready)
                else:
                    write_table(stored.repartitionByRange(wanted, *order).sortWithinPartitions(*order), ready)
                sizes = files.data_files(spark, ready)
                if wanted == 1 or max(sizes) <= max_bytes:
                    break
                # Smaller files compress less well, or the order is uneven.
                wanted = math.ceil(wanted * max(sizes) / target_bytes)
        _swap(spark, ready, path, old)
    finally:
        files.delete(spark, staging)
        files.delete(spark, ready)
        files.delete(spark, f"{ready}_probe")
    return max(len(sizes), 1)


def _dealt(rows: int, total: int, wanted: int, dealers: int) -> tuple[int, int]:
    """Tasks, and rows of a file, for about ``wanted`` files of a table of ``total`` bytes.

    Each of the ``dealers`` that read the stored copy gives every task the same number of
    rows or one more.  The rows of a file leave room for that, so that a task's last file
    is a little smaller than the others and none has the few rows that are left.
    """
    most = max(1, min(TASK_FILES, rows // max(1, wanted) // 16))
    tasks = max(math.ceil(total / TASK_BYTES), math.ceil(wanted / most))
    each = math.ceil(wanted / tasks)
    room = min(dealers, rows // wanted // 16)
    return tasks, max(1, math.ceil((rows / tasks + room) / each))


def _probed(
    stored: DataFrame, path: str, rows: int, total: int, wanted: int, dealers: int, target_bytes: int
) -> int:
    """The number of files for files of about ``target_bytes``, as one task's part of the rows compresses."""
    tasks, per_file = _dealt(rows, total, wanted, dealers)
    mark = F.pmod(F.xxhash64(*stored.columns), F.lit(tasks)) == 0
    _write_files(stored.where(mark), path, 1, per_file)
    largest = max(files.data_files(stored.sparkSession, path), default=0)
    return math.ceil(wanted * max(1.0, largest / target_bytes))


def fits(sizes: Sequence[int], wanted: int, max_bytes: int) -> bool:
    """Whether files may stay as they were written: one where one is wanted, else none
    too large, at most twice as many as wanted, and none much larger than the mean."""
    if wanted == 1:
        return len(sizes) <= 1
    mean = sum(sizes) / len(sizes)
    return len(sizes) <= 2 * wanted and max(sizes) <= min(max_bytes, 1.2 * mean) and min(sizes) >= mean / 1.2


def _swap(spark: SparkSession, ready: str, path: str, old: str) -> None:
    """Put a complete table in the place of another one, or leave that where it was."""
    replaced = files.exists(spark, path)
    if replaced:
        files.rename(spark, path, old)
    try:
        files.rename(spark, ready, path)
    except BaseException:
        if replaced:
            files.rename(spark, old, path)
        raise
    if replaced:
        files.delete(spark, old)


def recover(spark: SparkSession, path: str) -> bool:
    """Put back a table that a crashed write had moved aside; true if it did.

    The names say how far a write came: without a table in place, the one moved aside
    last is the current one.
    """
    left = files.matching(spark, f"{path}{STEP}old_*")
    if not left or files.exists(spark, path):
        return False
    files.rename(spark, left[-1], path)
    return True


def write_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace only the partitions present in ``df``; others stay as they are."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def write_by_month(df: DataFrame, path: str, epoch: str, month: str = MONTH) -> None:
    """Write a fact in one folder for each month (UTC) of its epoch seconds.

    A month's rows are brought together first, so that a task does not write a file
    for every month; adaptive execution splits a large month and merges small ones.
    Rows without a usable time have a folder of their own.
    """
    dated = df.withColumn(month, month_start(epoch_to_date(epoch)))
    dated.hint("rebalance", month).write.mode("overwrite").partitionBy(month).parquet(path)


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a result that several outputs use and return it as a scan.

    Unlike a cache it survives the loss of executors without recomputation.
    """
    write_table(df, path)
    spark: SparkSession = df.sparkSession
    return spark.read.schema(df.schema).parquet(path)
