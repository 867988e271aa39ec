"""Merging two states of an archive: the old wins, what is new is added."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_rows(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """All of ``old`` and the rows of ``new`` whose key it lacks."""
    return old.unionByName(new.join(old.select(key).distinct(), key, "left_anti").select(*old.columns))


def merge_stats(old: DataFrame, new: DataFrame, merged: DataFrame, section: str = "tweet_type") -> DataFrame:
    """Rows of each section before, in the update, and after."""
    tagged = None
    for name, df in (("old", old), ("new", new), ("merged", merged)):
        part = df.groupBy(section).agg(F.count("*").alias("n")).withColumn("state", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(section).pivot("state", ["old", "new", "merged"]).agg(F.coalesce(F.max("n"), F.lit(0))).na.fill(0)


def merge_metadata(old: DataFrame, new: DataFrame) -> DataFrame:
    """``archive_file, metadata`` (maps): new values win but for ``local_`` ones."""
    a, b = old.withColumnRenamed("metadata", "old"), new.withColumnRenamed("metadata", "new")
    none = F.create_map().cast("map<string,string>")
    local = F.map_filter(F.coalesce("old", none), lambda k, _: k.startswith("local_"))
    rest = F.map_filter(F.coalesce("old", none), lambda k, _: ~k.startswith("local_"))
    fresh = F.map_filter(F.coalesce("new", none), lambda k, _: ~F.map_contains_key(local, k))
    kept = F.map_filter(rest, lambda k, _: ~F.map_contains_key(F.coalesce("new", none), k))
    return a.join(b, "archive_file", "full").select("archive_file", F.map_concat(kept, fresh, local).alias("metadata"))
