"""Tables between the steps of an operator, and files that tasks write.

Everything lies in the folder named by ``spark.checkpoint.dir``, which driver
and executors share.  A table is complete or absent (Spark's commit protocol),
so a lost executor only repeats its own tasks.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Python workers give large arrays back to the system when they are freed; else an idle worker keeps
#: the memory of its largest task.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_MMAP_THRESHOLD_": "1000000",
    "MALLOC_TRIM_THRESHOLD_": "16000000",  # less, and loops over small arrays ask for them anew each time
    "MALLOC_ARENA_MAX": "2",
}


def share_code(spark: SparkSession) -> None:
    """Set up Python workers: how they keep memory, and where this package is.

    The folder matters where driver and workers share it; on a cluster the
    package is installed or sent with ``--py-files`` and the folder does not exist.
    """
    environment = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [PACKAGE_ROOT])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``.

    A local session without that setting gets one in the temporary folder, as
    driver and executors are one process there; any other master must set it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = f"file://{tempfile.gettempdir()}/llm-shared"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: lineage ends here."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_folder(url: str):
    """File system and path of a folder for use inside tasks; creates the folder."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(url if "://" in url or url.startswith("file:") else f"file://{url}")
    system.create_dir(path, recursive=True)
    return system, path
