"""Posts, threads, links and identities carried by the driver's tables.

The tables hold no archives, so deterministic projections stand in for them;
each has the same definition in SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Posts and likes: duplicates, likes, replies, missing times, snowflake ids.
SOURCE = """
SELECT CAST(((k * 86400000 + bucket) << 22) AS STRING) AS id, CAST(user_id AS STRING) AS user_id, concat('u', CAST(user_id AS STRING)) AS user_screen_name,
  concat('User ', CAST(user_id AS STRING)) AS user_name,
  CASE WHEN event_type = 'error' THEN CAST((((k {div} 2) * 86400000 + bucket) << 22) AS STRING) END AS in_reply_to_status_id,
  CASE WHEN event_type = 'error' THEN CAST((k * 7 + bucket) % 50 AS STRING) END AS in_reply_to_user_id,
  CASE WHEN event_type = 'error' THEN concat('a', CAST((k * 7 + bucket) % 50 AS STRING)) END AS in_reply_to_screen_name,
  0 AS retweet_count, CAST(k % 7 AS INT) AS favorite_count,
  concat(event_type, '-', CAST(CAST(floor(value * 100) AS BIGINT) AS STRING)) AS full_text,
  CASE WHEN event_type <> 'click' THEN ts END AS created_at,
  CASE event_type WHEN 'click' THEN 'like' WHEN 'signup' THEN 'note_tweet' WHEN 'view' THEN 'community_tweet' ELSE 'tweet' END AS tweet_type,
  concat('a', CAST(user_id % 5 AS STRING), '_archive.json') AS archive_file, event_type = 'error' AS is_reply
FROM (SELECT *, CAST({k} AS BIGINT) AS k, user_id % 32 + 32 * (event_id {div} 10000) AS bucket FROM events) e
"""
#: Trees of known shape.
THREAD = """
SELECT conv_id * 1000 + turn AS id, CASE WHEN turn > 0 THEN conv_id * 1000 + (turn - 1) {div} 2 END AS parent_id, role AS author, text,
  {at} AS created_at, CASE WHEN turn = 2 THEN concat('https://twitter.com/u/status/', CAST((conv_id * 17 + 3) % 100 * 1000 AS STRING), '?s=20') END AS quote_url
FROM conversations
"""
#: A change log of names.
IDENTITY = """
SELECT CAST(user_id AS STRING) AS user_id, ts, event_id AS seq, concat('n', {k}) AS username,
  CASE WHEN event_type = 'signup' THEN concat('d', {k}) END AS display_name, CASE WHEN event_type = 'purchase' THEN concat('v', {k}) END AS avatar_url
FROM events
"""
_SPARK = {"div": "div", "k": "get_json_object(props, '$.k')", "at": "timestamp_seconds(1577836800 + conv_id * 3600 + turn * 60)"}
_DUCK = {"div": "//", "k": "json_extract_string(props, '$.k')", "at": "make_timestamp((1577836800 + conv_id * 3600 + turn * 60) * 1000000)"}


def duck(sql: str) -> str:
    """A carrier's definition for the oracle."""
    out = sql.format(**_DUCK)
    for a, b in (("AS STRING", "AS VARCHAR"), ("<< 22)", "<< 22)")):
        out = out.replace(a, b)
    return out.strip()


def _view(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if table == "events":
        df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    return spark.sql(sql.format(**_SPARK).replace(f"FROM {table}", "FROM {t}"), t=df)


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SOURCE, "events")


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, THREAD, "conversations")


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, IDENTITY, "events")
