"""Sinks: Parquet, partitioned export, JSON lines and texts."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions import scalar


def parquet(df: DataFrame, path: str, rows_per_file: int = 100_000, mode: str = "overwrite") -> None:
    """ZSTD Parquet with bounded files; Spark's commit makes it whole or absent."""
    df.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)


def by_user(df: DataFrame, path: str, user: str = "user_screen_name", rows_per_file: int = 100_000) -> None:
    """One folder a user, by file-safe names; rows without a name go to ``_``.

    Rows meet by user, but the exchange may be dealt anew: adaptive execution
    splits a hot user's rows over tasks, and files are bounded.
    """
    named = scalar.safe_name(F.coalesce(F.nullif(F.col(user), F.lit("")), F.lit("_")))
    df.withColumn("user_safe", named).hint("rebalance", F.col("user_safe")).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("user_safe").parquet(path)


def lines(df: DataFrame, path: str, column: str = "line", single: bool = False) -> None:
    """A text file of the column's values; ``single`` keeps one ordered file."""
    out = df.select(F.col(column).cast("string").alias("value"))
    (out.coalesce(1) if single else out).write.mode("overwrite").text(path)


def with_backup(df: DataFrame, path: str) -> str | None:
    """Replaces ``path``; an earlier state is renamed to ``path.backup-<time>``.

    The new state is written beside it first, so a write that fails leaves the
    earlier one in place.
    """
    spark = df.sparkSession
    jvm = spark._jvm
    stamp = time.strftime("%Y%m%d-%H%M%S")
    old, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.new-{stamp}")
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    parquet(df, str(new.toString()))
    backup = None
    if fs.exists(old):
        backup = f"{path}.backup-{stamp}"
        fs.rename(old, jvm.org.apache.hadoop.fs.Path(backup))
    fs.rename(new, old)
    return backup


def schema_json(df: DataFrame) -> str:
    return df.schema.json()
