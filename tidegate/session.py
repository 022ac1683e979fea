"""Session facts and file-system helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_base: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """A new folder every executor can reach, below ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder on this machine.
    """
    global _local_base
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="tidegate-")
        base = _local_base
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def write_marker(spark: SparkSession, path: str) -> None:
    """An empty file."""
    p, fs = _path(spark, path)
    fs.create(p, True).close()


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists and holds anything but markers."""
    p, fs = _path(spark, path)
    return fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def folders_of(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Gives a folder another place in the same store."""
    p, fs = _path(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise RuntimeError(f"{path} was not moved to {to}")


def folder_bytes(spark: SparkSession, path: str) -> int:
    p, fs = _path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def folder_files(spark: SparkSession, path: str) -> int:
    p, fs = _path(spark, path)
    return fs.getContentSummary(p).getFileCount() if fs.exists(p) else 0


def fit_generated_code(spark: SparkSession) -> None:
    """Keep the generated code of long rule lists compilable.

    The JVM never compiles methods above 8000 bytes of bytecode and interprets them instead.
    With this limit Spark falls back to many small methods there, which is several times
    faster.  A limit set by the user is left alone.
    """
    key, default = "spark.sql.codegen.hugeMethodLimit", "65535"
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, "8000")
