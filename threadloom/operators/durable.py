"""Tables that outlive executors: written to the folder all of them share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local master may go without one: a temporary folder, which its single
    JVM sees as a whole. On a cluster each executor would write to its own disk.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = held.get() if held.isDefined() else None
    if not found:
        if not re.match(r"local(\[(?!.*cluster)|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="threadloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def written(df: DataFrame, tag: str, **options: object) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back; ``options`` are the writer's."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/threadloom/{tag}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Removes all written tables of the shared folder; no result that reads them may be open."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/threadloom")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
