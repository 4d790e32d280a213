"""Tables written between the parts of a job, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The folder of each application that has none of its own.
_OWN: dict[str, str] = {}
#: Shuffle files of a query go when it ends; the table it has written stays.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a temporary folder if all runs on
    this machine, and an error on a cluster, whose executors would not see that folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = _OWN.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="kinoframe-")
        _OWN[spark.sparkContext.applicationId] = folder
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` made and no result needs any longer."""
    for table in tables:
        for file in table.inputFiles()[:1]:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
