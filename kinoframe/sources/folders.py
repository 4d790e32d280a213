"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def work_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh folder in ``spark.checkpoint.dir``; where that is unset, a temporary one if all runs on
    this machine, and an error on a cluster, whose executors would not see it.
    """
    folder, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = _OWN.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="kinoframe-")
        _OWN[context.applicationId] = folder
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder and read again, for what several jobs read."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``kept`` made and nothing reads any longer."""
    for table in tables:
        for file in table.inputFiles()[:1]:
            fs, path = qualified(table.sparkSession, file.rsplit("/", 1)[0])
            fs.delete(path, True)


def qualified(spark: SparkSession, path: str):
    """(file system, path with its scheme) as Hadoop has them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = qualified(spark, path)
    return bool(fs.exists(p))


def required(spark: SparkSession, path: str, what: str) -> str:
    """The path, or an error that says what is missing there."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no {what} at {path}")
    return path
