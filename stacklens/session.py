"""Session settings, the shared folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Bytes of a batch for Python tasks, which the JVM and Python both hold outside the heap.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings every job here relies on (safe to repeat)."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    _show_package(spark)
    return spark


def _show_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did (a cluster gets it by --py-files)."""
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, since a machine-local folder would
    be lost together with its executor.
    """
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    path = path or context.getCheckpointDir()
    if path is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="stacklens-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there: pruned columns, statistics, no lineage.

    The files go when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    files, hadoop = _files(spark, path)
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    df.write.parquet(f"{path}/rows")
    return spark.read.schema(df.schema).parquet(f"{path}/rows")


@contextmanager
def file_per_task(spark: SparkSession) -> Iterator[None]:
    """What runs inside reads one whole file per task, where each file holds as much as a task can."""
    settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key in settings:
            spark.conf.set(key, str(1 << 30))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = _files(spark, path)
    return files.exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    files, hadoop = _files(spark, path)
    files.delete(hadoop, True)


def numbered_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers n of the folders ``path``/``prefix``n, ascending."""
    files, hadoop = _files(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(hadoop)] if files.exists(hadoop) else []
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))
