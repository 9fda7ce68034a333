"""File system access through Hadoop, so any storage Spark can read works."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

HEAD_BYTES = 4096
HEAD_READERS = 32
# So many sizes are asked for one by one; those of more files are read by tasks.
ASKED_FILES = 256


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path(spark, path)
    return fs.exists(jpath)


def delete(spark: SparkSession, path: str) -> None:
    jpath, fs = _path(spark, path)
    fs.delete(jpath, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    jsource, fs = _path(spark, source)
    if not fs.rename(jsource, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted."""
    jpath, fs = _path(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(jpath) or [])


def data_files(spark: SparkSession, path: str) -> list[int]:
    """Sizes in bytes of the Parquet files of a directory table."""
    jpath, fs = _path(spark, f"{path}/*.parquet")
    found = fs.globStatus(jpath) or []
    if len(found) <= ASKED_FILES:
        return [status.getLen() for status in found]
    entries = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return [r["length"] for r in entries.select("length").collect()]


def largest_file(spark: SparkSession, path: str) -> int:
    """Size in bytes of a file, or of the largest file directly in a folder."""
    jpath, fs = _path(spark, path)
    return max((status.getLen() for status in fs.listStatus(jpath)), default=0)


def first_line(spark: SparkSession, path: str) -> tuple[str, str]:
    """First line of a text file and what ends it: LF, CR LF or CR.

    LF where the file has no line end.  Reads a few kilobytes, more only for a
    longer first line.
    """
    jpath, fs = _path(spark, path)
    stream = fs.open(jpath)
    try:
        head, size = b"", HEAD_BYTES
        while True:
            more = bytes(stream.readNBytes(size))
            head, size = head + more, 4 * size
            ends = [k for k in (head.find(b"\n"), head.find(b"\r")) if k >= 0]
            # A carriage return at the end of what was read may precede a line feed.
            if not more or ends and min(ends) + 1 < len(head):
                break
    finally:
        stream.close()
    at = min(ends, default=len(head))
    end = "\r\n" if head[at : at + 2] == b"\r\n" else "\r" if head[at : at + 1] == b"\r" else "\n"
    return head[:at].decode("utf-8", "replace"), end


def first_lines(spark: SparkSession, paths: list[str]) -> list[tuple[str, str]]:
    """:func:`first_line` of each file, many files at once.

    The head of a file is metadata that the plan needs, as the footer of a Parquet
    file is, so it is read before any task runs.
    """
    with ThreadPoolExecutor(HEAD_READERS) as pool:
        return list(pool.map(lambda path: first_line(spark, path), paths))


def make_folder(spark: SparkSession, path: str) -> None:
    jpath, fs = _path(spark, path)
    fs.mkdirs(jpath)


def text_files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the files directly in a folder that Spark would read."""
    jpath, fs = _path(spark, path)
    status = fs.getFileStatus(jpath)
    entries = fs.listStatus(jpath) if status.isDirectory() else [status]
    names = [(e.getPath().getName(), e.getPath().toString()) for e in entries if e.isFile()]
    return sorted(full for name, full in names if not name.startswith(("_", ".")))


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables in the one named by ``spark.checkpoint.dir``.

    Where that is unset, a local session (one process, as in tests) gets a
    temporary folder with a warning; any other master raises an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        warnings.warn("spark.checkpoint.dir is unset; using a local temporary folder", stacklevel=2)
        shared = tempfile.mkdtemp(prefix="reviewlens-")
    return f"{shared.rstrip('/')}/reviewlens-{uuid.uuid4().hex}"
