"""Threads that grow: the closure of replies kept up to date, batch by batch.

For every post the state holds its topmost known ancestor and how far up that is.
A batch touches the posts it brings and the tops whose missing parent arrives with
it; only these are contracted, by pointer jumping as in ``threads.closure``, and of
the rest only the members of moved tops get new rows. The state is a folder of
versions: each holds the rows that its batch changed, nothing is rewritten, and
the last row of a post counts. A version appears in one step, by a rename.

Defined results: after any batches, in any order and with posts that come again,
``closure`` of the state equals that of all posts at once; posts in or below a cycle
have no top and are left out; a post that comes again keeps its first parent; rows
without id are left out; an empty batch adds a version without rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.durable import written

_STATE = ["id", "parent_id", "top", "steps"]


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the versions that are there, ascending."""
    fs, path = _files(spark, folder)
    if not fs.exists(path(folder)):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path(folder))]
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def current(spark: SparkSession, folder: str) -> DataFrame | None:
    """``id, parent_id, top, steps`` of every post: its row of the last version."""
    found = versions(spark, folder)
    if not found:
        return None
    every = spark.read.option("basePath", folder).parquet(*[f"{folder}/version={v}" for v in found])
    last = F.max_by(F.struct("parent_id", "top", "steps"), "version").alias("r")
    return every.groupBy("id").agg(last).select("id", "r.*")


def _commit(rows: DataFrame, folder: str, version: int) -> None:
    spark = rows.sparkSession
    fs, path = _files(spark, folder)
    aside = f"{folder}/_new-{uuid.uuid4().hex}"
    rows.select(*_STATE).write.parquet(aside)
    if not fs.rename(path(aside), path(f"{folder}/version={version}")):
        raise OSError(f"version {version} of {folder} is there already")


def extend(batch: DataFrame, folder: str) -> DataFrame:
    """Adds posts ``(id, parent_id)`` to the state; the rows that this changed."""
    spark, c = batch.sparkSession, F.col
    found = versions(spark, folder)
    posts = batch.where("id is not null").groupBy("id").agg(F.min("parent_id").alias("parent_id"))
    state = current(spark, folder)
    if state is None:
        state = posts.select("id", "parent_id", c("id").alias("top"), F.lit(0).cast("long").alias("steps")).limit(0)
    state = written(state, "growing-state")
    new = written(posts.join(state.select("id"), "id", "left_anti"), "growing-new")
    among, above = new.select(c("id").alias("near")), state.select(c("id").alias("far"), c("top").alias("far_top"), c("steps").alias("far_steps"))
    put = new.join(among, c("parent_id") == c("near"), "left").join(above, c("parent_id") == c("far"), "left")
    alone = c("near").isNull() & c("far").isNull()
    own = put.select(
        "id", F.when(c("near").isNotNull(), c("parent_id")).when(c("far").isNotNull(), c("far_top")).otherwise(c("id")).alias("up"),
        F.when(c("near").isNotNull(), 1).when(c("far").isNotNull(), c("far_steps") + 1).otherwise(0).cast("long").alias("steps"), alone.alias("done"),
    )
    moved = state.where("id = top").join(among, c("parent_id") == c("near")).select("id", c("parent_id").alias("up"), F.lit(1).cast("long").alias("steps"), F.lit(False).alias("done"))
    ups = written(own.unionByName(moved).withColumn("done", c("done") | c("up").isNull()), "growing")
    open_ = None
    while True:
        left = ups.where("not done").count()
        if left == 0 or left == open_:
            break
        open_ = left
        up = ups.select(c("id").alias("up"), c("up").alias("up2"), c("steps").alias("more"), F.lit(True).alias("here"))
        step = ups.where("not done").join(up, "up", "left")  # an ancestor that is not here is a top that stays
        step = step.select("id", F.when(c("here"), c("up2")).otherwise(c("up")).alias("up"), (c("steps") + F.coalesce("more", F.lit(0))).alias("steps"), (c("here").isNull() | (c("more") == 0) | c("up2").isNull()).alias("done"))
        ups = written(ups.where("done").unionByName(step), "growing")
    ends = ups.select("id", F.when(c("done"), c("up")).alias("new_top"), c("steps").alias("new_steps"))  # what is open still runs in a circle
    added = new.join(ends, "id").select("id", "parent_id", c("new_top").alias("top"), c("new_steps").alias("steps"))
    tops = written(moved.select(c("id").alias("top")).join(ends.withColumnRenamed("id", "top"), "top"), "growing-moved")
    shifted = state.join(tops, "top").select("id", "parent_id", c("new_top").alias("top"), (c("steps") + c("new_steps")).alias("steps"))
    changed = written(added.unionByName(shifted), "growing-changed")
    _commit(changed, folder, (found[-1] if found else 0) + 1)
    return changed


def closure(spark: SparkSession, folder: str) -> DataFrame:
    """``root_id, id, depth`` as ``threads.closure`` gives them for all posts so far."""
    below = current(spark, folder).where("top is not null and steps > 0").select(F.col("top").alias("root_id"), "id", F.col("steps").alias("depth"))
    roots = below.select("root_id").distinct()
    return roots.select("root_id", F.col("root_id").alias("id"), F.lit(0).cast("long").alias("depth")).unionByName(below)


def compact(spark: SparkSession, folder: str) -> None:
    """One version with the last row of every post, after which the older ones go."""
    found = versions(spark, folder)
    if len(found) < 2:
        return
    _commit(written(current(spark, folder), "growing-state"), folder, found[-1] + 1)
    fs, path = _files(spark, folder)
    for v in found:
        fs.delete(path(f"{folder}/version={v}"), True)
