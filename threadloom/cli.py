"""Command line: build, consolidate, threads, export and urls over archives."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from threadloom.operators import consolidate, exports, merging, profile, threads
from threadloom.operators import links as url_ops
from threadloom.sources import archives, sinks, splittable, tails


def _posts(tweets):
    full = consolidate.best_versions(tweets)
    return full.select(
        "id", F.nullif("in_reply_to_status_id", F.lit("")).alias("parent_id"), F.col("user_screen_name").alias("author"), F.col("full_text").alias("text"), "created_at",
        F.transform("media", lambda m: F.struct(F.lit("media").alias("type"), m.alias("media_url"))).alias("media"), "urls",
    )


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="threadloom", description=__doc__)
    p.add_argument("command", choices=["build", "users", "consolidate", "threads", "export", "urls", "signatures", "canonicalize", "verify", "inspect", "url-report", "merge", "tails"])
    p.add_argument("archives", help="folder of *_archive.json files")
    p.add_argument("output")
    p.add_argument("--format", default="oai", choices=sorted(exports.FORMATS))
    p.add_argument("--system-message", default=exports.SYSTEM)
    p.add_argument("--split", action="store_true", help="read large archives by many tasks")
    p.add_argument("--with", dest="newer", help="merge: folder of the newer state of the archives")
    p.add_argument("--glob", default="*_archive.json")
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "tails":
        sinks.parquet(tails.archive_tails(spark, a.archives, a.glob), a.output)
        return 0
    if a.split:
        parts = splittable.read(spark, a.archives, a.glob)
        found, tweets = parts.archives, splittable.source_tweets(parts)
    else:
        found = archives.read_archives(spark, a.archives, a.glob)
        tweets = archives.source_tweets(found)
    if a.command == "build":
        sinks.parquet(tweets, a.output)
    elif a.command == "users":
        sinks.parquet(consolidate.users(tweets), a.output)
    elif a.command == "consolidate":
        sinks.parquet(consolidate.consolidated(tweets), a.output)
    elif a.command == "threads":
        sinks.parquet(threads.closure(_posts(tweets)), a.output)
    elif a.command == "export":
        lines = exports.export(threads.direct_threads(_posts(tweets)), a.format, a.system_message)
        sinks.lines(lines.orderBy("root_id"), a.output)
    elif a.command == "merge":
        if not a.newer:
            p.error("merge needs --with, the folder of the newer state")
        newer = archives.read_archives(spark, a.newer, a.glob)
        states = [(x, y.withColumn("key", F.concat_ws("\x1f", "archive_file", "tweet_type", "id"))) for x, y in ((found, tweets), (newer, archives.source_tweets(newer)))]
        (old_files, old), (new_files, new) = states
        merged = merging.merge_rows(old, new, "key")
        meta = [archives.archive_metadata(x).select("archive_file", F.from_json("metadata", "map<string,string>").alias("metadata")) for x in (old_files, new_files)]
        for name, table in (("tweets", merged.drop("key")), ("stats", merging.merge_stats(old, new, merged)), ("metadata", merging.merge_metadata(*meta))):
            sinks.parquet(table, f"{a.output}/{name}")
    elif a.command == "canonicalize":
        sinks.lines(exports.canonical_json(consolidate.canonical(tweets)), a.output)
    elif a.command == "verify":
        for name, table in profile.verification(tweets, consolidate.consolidated(tweets)).items():
            sinks.parquet(table, f"{a.output}/{name}")
    elif a.command == "inspect":
        for name, table in profile.inspection(tweets).items():
            sinks.parquet(table, f"{a.output}/{name}")
    elif a.command in ("urls", "url-report"):
        posts = tweets.where("tweet_type = 'tweet'").select(
            F.regexp_replace("archive_file", r"_archive\.json$", "").alias("username"), F.col("id").alias("tweet_id"), F.col("created_at").alias("tweet_created_at"), "full_text", F.col("urls").alias("entity_urls")
        )
        table = url_ops.url_table(posts)
        sinks.parquet(url_ops.overall(table) if a.command == "url-report" else table, a.output)
    else:
        sinks.parquet(archives.format_signatures(found), a.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
