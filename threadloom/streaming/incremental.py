"""Incremental ingestion with Structured Streaming (beyond the reference).

New archives are picked up as files arrive; the checkpoint is the record of
what has been processed, so a restarted run takes only what is new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadloom.sources import archives


def archive_stream(spark: SparkSession, path: str, files_per_batch: int = 64, glob: str = "*_archive.json") -> DataFrame:
    """Posts and likes of archives as they arrive, 23 columns."""
    raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch).text(path, wholetext=True, pathGlobFilter=glob)
    files = raw.select(F.col("_metadata.file_name").alias("archive_file"), F.col("value").alias("raw"))
    return archives.source_tweets(archives.parse_archives(files))


def ingest(spark: SparkSession, path: str, out: str, checkpoint: str, **options) -> StreamingQuery:
    """Appends what is new to a Parquet table and ends."""
    rows = archive_stream(spark, path, **options)
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(out)


def first_seen_urls(events: DataFrame, ttl: str = "30 days", url: str = "url", at: str = "ts") -> DataFrame:
    """Each url once within its time to live; state is bounded by the watermark."""
    return events.withWatermark(at, ttl).dropDuplicatesWithinWatermark([url])


def activity(events: DataFrame, window: str = "1 hour", late: str = "10 minutes", at: str = "ts", kind: str = "event_type") -> DataFrame:
    """Counts of each kind in event-time windows."""
    return events.withWatermark(at, late).groupBy(F.window(at, window), kind).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes", at: str = "ts", user: str = "user_id") -> DataFrame:
    """A user's sessions: bursts of events without a gap."""
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap), user).agg(F.count("*").alias("n"))
