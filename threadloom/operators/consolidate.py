"""One row a post: dedup, likers, inferred authors and times."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import scalar


def likers(tweets: DataFrame) -> DataFrame:
    """``id, liked_by_users, like_count``: who likes each post, from all rows."""
    some = tweets.where("tweet_type = 'like' and user_id is not null")
    return some.groupBy("id").agg(F.array_sort(F.collect_set("user_id")).alias("liked_by_users"), F.count_distinct("user_id").alias("like_count"))


def best_versions(tweets: DataFrame) -> DataFrame:
    """The best row of each id: no like, dated, longest; ties by file, type, user."""
    order = [
        (F.col("tweet_type") != "like").desc(), F.col("created_at").isNotNull().desc(), F.length(F.coalesce("full_text", F.lit(""))).desc(),
        F.col("archive_file").asc_nulls_last(), F.col("tweet_type").asc_nulls_last(), F.col("user_id").asc_nulls_last(), F.col("full_text").asc_nulls_last(), F.col("created_at").asc_nulls_last(),
    ]
    ranked = tweets.withColumn("rn", F.row_number().over(Window.partitionBy("id").orderBy(*order)))
    return ranked.where("rn = 1").drop("rn")


def inferred_authors(deduped: DataFrame) -> DataFrame:
    """Author of posts known only by likes: whom replies to them name most."""
    liked = deduped.where("tweet_type = 'like' and id <> ''").select(F.col("id").alias("liked"))
    named = deduped.where("in_reply_to_screen_name is not null and in_reply_to_status_id <> ''")
    counted = named.join(liked, F.col("in_reply_to_status_id") == F.col("liked")).groupBy("liked", "in_reply_to_user_id", "in_reply_to_screen_name").agg(F.count("*").alias("n"))
    first = Window.partitionBy("liked").orderBy(F.desc("n"), F.col("in_reply_to_user_id").asc_nulls_last(), F.col("in_reply_to_screen_name").asc_nulls_last())
    one = counted.withColumn("rn", F.row_number().over(first)).where("rn = 1")
    return one.select(F.col("liked").alias("id"), F.col("in_reply_to_user_id").alias("author_id"), F.col("in_reply_to_screen_name").alias("author_screen_name"), F.col("n").alias("occurrences"))


def consolidated(tweets: DataFrame) -> DataFrame:
    """One row an id with its likers, inferred author and inferred time."""
    deduped = best_versions(tweets)
    authors = inferred_authors(deduped).select("id", "author_id", "author_screen_name")
    like = F.col("tweet_type") == "like"
    whole = deduped.join(authors, "id", "left").withColumns(
        {
            "user_id": F.when(like, F.col("author_id")).otherwise(F.col("user_id")),
            "user_screen_name": F.when(like, F.col("author_screen_name")).otherwise(F.col("user_screen_name")),
        }
    )
    none = F.array().cast("array<string>")
    return (
        whole.drop("author_id", "author_screen_name")
        .join(likers(tweets), "id", "left")
        .withColumn("liked_by_users", F.coalesce("liked_by_users", none))
        .withColumn("like_count", F.coalesce("like_count", F.lit(0)).cast("long"))
        .withColumn("inferred_timestamp", scalar.inferred_time("created_at", "id"))
    )


def users(tweets: DataFrame) -> DataFrame:
    """Users with the number of their rows; nulls become ''."""
    counted = tweets.groupBy("user_id", "user_screen_name", "user_name").agg(F.count("*").alias("tweet_count"))
    text = lambda x: F.coalesce(x, F.lit("")).alias(x)
    return counted.select(text("user_id"), text("user_screen_name"), text("user_name"), "tweet_count").distinct()


def canonical(posts: DataFrame) -> DataFrame:
    """Posts of all archives merged by number; likes of unseen posts stand in.

    The fullest version wins (a post before a like, then the longest text,
    then the first file); authors, likers and replies are united, and a post
    without author takes the name its replies use.
    """
    ided = posts.where(scalar.valid_id("id")).withColumn("num", F.col("id").cast("bigint"))
    order = [(F.col("tweet_type") == "like").asc(), F.length(F.coalesce("full_text", F.lit(""))).desc(), F.col("archive_file").asc_nulls_last(), F.col("tweet_type").asc(), F.col("user_id").asc_nulls_last(), F.col("full_text").asc_nulls_last(), F.col("created_at").asc_nulls_last()]
    best = ided.withColumn("rn", F.row_number().over(Window.partitionBy("num").orderBy(*order))).where("rn = 1")
    parent = F.when(scalar.valid_id("in_reply_to_status_id"), F.col("in_reply_to_status_id").cast("bigint"))
    edges = ided.select(parent.alias("num"), F.col("num").alias("child"), "in_reply_to_screen_name").where("num is not null")
    replies = edges.groupBy("num").agg(F.array_sort(F.collect_set("child")).alias("reply_ids"), F.min("in_reply_to_screen_name").alias("named"))
    liked = ided.where("tweet_type = 'like' and user_screen_name is not null").groupBy("num").agg(F.array_sort(F.collect_set("user_screen_name")).alias("likers"))
    own = F.when(F.col("tweet_type") != "like", F.nullif("user_screen_name", F.lit("")))
    return (
        best.join(replies, "num", "left")
        .join(liked, "num", "left")
        .select(
            F.col("num").alias("id"),
            F.coalesce("full_text", F.lit("")).alias("text"),
            scalar.inferred_time("created_at", "id").alias("created_at"),
            F.coalesce(own, "named").alias("author_username"),
            "retweet_count",
            parent.alias("in_reply_to_status_id"),
            F.col("in_reply_to_screen_name").alias("in_reply_to_username"),
            F.coalesce("likers", F.array().cast("array<string>")).alias("likers"),
            F.coalesce("reply_ids", F.array().cast("array<bigint>")).alias("reply_ids"),
        )
    )
