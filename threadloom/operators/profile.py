"""Verification and profile reports: one small table of figures each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import scalar
from threadloom.operators import consolidate, threads
from threadloom.operators.durable import written
from threadloom.operators.quantiles import quantiles


def _blank(x: str) -> Column:
    return F.col(x).isNull() | (F.col(x) == "")


def counts(tweets: DataFrame) -> DataFrame:
    return tweets.agg(F.count("*").alias("n_rows"), F.count_distinct("id").alias("ids"), F.count_distinct("user_id").alias("user_ids"))


def share_by(df: DataFrame, key: str, digits: int = 2) -> DataFrame:
    """Rows of each value and their percentage of all."""
    counted = df.groupBy(key).agg(F.count("*").alias("n"))
    return counted.withColumn("pct", scalar.percent(F.col("n"), F.sum("n").over(Window.partitionBy()), digits))


def type_shares(tweets: DataFrame) -> DataFrame:
    return share_by(tweets, "tweet_type")


def gaps(tweets: DataFrame, by: str = "tweet_type") -> DataFrame:
    """Missing authors and times for each kind of row."""
    missing = F.count_if(_blank("user_id"))
    undated = F.count_if(F.col("created_at").isNull())
    return tweets.groupBy(by).agg(
        F.count("*").alias("total"), missing.alias("no_author"), scalar.percent(missing, F.count("*")).alias("no_author_pct"), undated.alias("no_time"), scalar.percent(undated, F.count("*")).alias("no_time_pct")
    )


def null_checks(tweets: DataFrame, columns: tuple[str, ...] = ("id", "user_id", "user_screen_name", "full_text", "created_at", "in_reply_to_status_id")) -> DataFrame:
    one = tweets.agg(*[F.count_if(F.col(x).isNull()).alias(x) for x in columns])
    return one.unpivot([], list(columns), "column_name", "nulls")


def duplicates(tweets: DataFrame) -> DataFrame:
    """Ids that occur more than once and what dedup would save."""
    per = tweets.groupBy("id").agg(F.count("*").alias("n"))
    twice = F.col("n") > 1
    return per.agg(
        F.sum("n").alias("total"),
        F.count("id").alias("ids"),
        F.count_if(twice).alias("duplicate_ids"),
        F.coalesce(F.sum(F.when(twice, F.col("n") - 1)), F.lit(0)).alias("excess"),
    ).withColumn("reduction_pct", scalar.percent(F.col("excess"), F.col("total")))


def duplicate_rows(tweets: DataFrame, n: int = 10) -> DataFrame:
    """All rows of ``n`` ids that occur more than once: those of the smallest digests."""
    twice = tweets.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.md5("id"), "id").limit(n).select("id")
    return tweets.join(F.broadcast(twice), "id", "left_semi").select("id", "tweet_type", "user_screen_name", "archive_file", "full_text")  # n rows


def table_profile(df: DataFrame, at: str, text: str = "full_text") -> DataFrame:
    """Rows, distinct rows, range of times and texts with entities of a table."""
    each = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))  # copies shrink before they meet
    holds = lambda x: F.coalesce(F.sum(F.when(F.col(text).contains(x), F.col("__n"))), F.lit(0))
    return each.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"), F.count("*").alias("unique_rows"), F.min(at).alias("first_at"), F.max(at).alias("last_at"),
        holds("@").alias("with_at"), holds("#").alias("with_hash"), holds("http").alias("with_link"),
    )


def type_pairs(tweets: DataFrame) -> DataFrame:
    """Kinds of the two best versions of duplicated ids, in one pass over windows."""
    order = Window.partitionBy("id").orderBy(scalar.type_priority("tweet_type"), "tweet_type", "archive_file", "full_text")
    ranked = tweets.withColumn("rn", F.row_number().over(order)).where("rn <= 2")
    both = ranked.groupBy("id").agg(F.max(F.when(F.col("rn") == 1, F.col("tweet_type"))).alias("first_type"), F.max(F.when(F.col("rn") == 2, F.col("tweet_type"))).alias("second_type"))
    counted = both.where("second_type is not null").groupBy("first_type", "second_type").agg(F.count("*").alias("n"))
    return counted.withColumn("pct", scalar.percent(F.col("n"), F.sum("n").over(Window.partitionBy()), 3))


def liked_and_full(tweets: DataFrame) -> DataFrame:
    """Ids that have both likes and a full version."""
    like = F.col("tweet_type") == "like"
    per = tweets.groupBy("id").agg(F.count_if(like).alias("likes"), F.count_if(~like).alias("fulls"))
    return per.agg(F.count_if((F.col("likes") > 0) & (F.col("fulls") > 0)).alias("both"), F.count_if(F.col("fulls") == 0).alias("like_only"), F.count_if(F.col("likes") == 0).alias("full_only"))


def like_distribution(consolidated: DataFrame) -> DataFrame:
    """Figures of the likes; the medians are selected exactly, in bounded memory."""
    n = F.col("like_count")
    some = F.when(n > 0, n)
    held = written(consolidated.select("like_count"), "like-counts")
    (median_all,), (median_liked,) = quantiles(held, "like_count", [0.5]), quantiles(held.where(n > 0), "like_count", [0.5])
    return held.agg(
        F.count("*").alias("total"), F.coalesce(F.sum(n), F.lit(0)).alias("likes"), F.count_if(n > 0).alias("liked"), F.min(n).alias("min_likes"), F.max(n).alias("max_likes"),
        F.round(F.avg(n), 6).alias("avg_all"), F.round(F.avg(some), 6).alias("avg_liked"), F.lit(median_all).cast("double").alias("median_all"), F.lit(median_liked).cast("double").alias("median_liked"),
    )


def time_stats(consolidated: DataFrame) -> DataFrame:
    made = F.col("created_at").isNull() & F.col("inferred_timestamp").isNotNull()
    return consolidated.agg(
        F.count("*").alias("total"), F.count("created_at").alias("original"), F.count_if(made).alias("inferred"), F.count_if(F.col("inferred_timestamp").isNull()).alias("without"),
        F.round(scalar.days_between(F.min("created_at"), F.max("created_at")), 3).alias("days"),
    )


def author_stats(consolidated: DataFrame) -> DataFrame:
    like = F.col("tweet_type") == "like"
    return consolidated.agg(
        F.count_if(like).alias("likes"), F.count_if(like & ~_blank("user_id")).alias("with_user_id"), F.count_if(like & ~_blank("user_screen_name")).alias("with_screen_name"),
        scalar.percent(F.count_if(like & ~_blank("user_id")), F.count_if(like)).alias("inferred_pct"),
    )


def missing_ids(original: DataFrame, consolidated: DataFrame) -> DataFrame:
    gone = original.where("id is not null").join(consolidated.select("id"), "id", "left_anti")
    return gone.agg(F.count_distinct("id").alias("missing"))


def version_counts(tweets: DataFrame) -> DataFrame:
    """Every row with how many rows share its id, null ids among them; counted first, so a frequent id is no window."""
    counted = tweets.groupBy(F.col("id").alias("__id")).agg(F.count("*").alias("versions"))
    return tweets.join(counted, F.col("id").eqNullSafe(F.col("__id"))).drop("__id")


def first_authors(tweets: DataFrame, top: int = 25) -> DataFrame:
    """The first distinct authors of replies in the order of their names."""
    return tweets.where("is_reply").select("user_screen_name", "user_name").distinct().orderBy("user_screen_name", "user_name").limit(top)


def reply_stats(tweets: DataFrame) -> DataFrame:
    reply = F.col("in_reply_to_status_id").isNotNull()
    return tweets.agg(F.count("*").alias("total"), F.count_if(reply).alias("replies"), F.count_distinct(F.when(reply, F.col("in_reply_to_status_id"))).alias("targets"))


def thread_size_stats(sizes: DataFrame) -> DataFrame:
    n = F.col("replies")
    sizes = written(sizes.select("replies"), "thread-sizes")
    (median,) = quantiles(sizes, "replies", [0.5])
    return sizes.agg(
        F.count("*").alias("threads"), F.min(n).alias("least"), F.max(n).alias("most"), F.round(F.avg(n), 6).alias("mean"), F.lit(median).cast("double").alias("median_replies"),
        F.count_if(n >= 10).alias("ten_or_more"), F.count_if(n >= 50).alias("fifty_or_more"),
    )


def top_liked(consolidated: DataFrame, top: int = 5) -> DataFrame:
    best = consolidated.orderBy(F.desc("like_count"), "id").limit(top)
    return best.select("id", "like_count", F.array_join(F.slice("liked_by_users", 1, 5), ", ").alias("first_likers"), scalar.preview("full_text").alias("preview"))


def sample_of_type(tweets: DataFrame, kind: str, n: int = 3, seed: int = 7) -> DataFrame:
    """A repeatable sample: smallest hashes first."""
    rows = tweets.where(F.col("tweet_type") == kind)
    return rows.orderBy(F.md5(F.concat_ws("\x1f", F.lit(str(seed)), "id", "archive_file", "full_text")), "id").limit(n).select("id", "user_screen_name", scalar.preview("full_text", 100).alias("preview"), "archive_file")


def text_profile(docs: DataFrame, by: str, text: str = "text") -> DataFrame:
    n = F.length(text)
    return docs.groupBy(by).agg(F.count("*").alias("n"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.round(F.avg(n), 4).alias("mean_length"), F.count_if(F.col(text).contains("@")).alias("with_at"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.array_join(F.array_sort(F.collect_set(column)), ", ").alias("values"))


def array_lengths(df: DataFrame, column: str, by: str) -> DataFrame:
    """Entries of an array column, or of a JSON array in a string column."""
    n = F.json_array_length(column) if df.schema[column].dataType.simpleString() == "string" else F.size(column)
    n = F.coalesce(n, F.lit(0))
    return df.groupBy(by).agg(F.count("*").alias("n"), F.sum(n).alias("entries"), F.count_if(n > 0).alias("with_entries"), F.max(n).alias("most"))


def rows_with(df: DataFrame, column: str, value) -> DataFrame:
    """Rows of one value, by a bound parameter."""
    return df.sparkSession.sql(f"SELECT * FROM {{t}} WHERE `{column}` = :value", args={"value": value}, t=df)


def liker_sample(original: DataFrame, consolidated: DataFrame, n: int = 5, seed: int = 7) -> DataFrame:
    """Liked posts drawn by digest: the likers that they were given, and those counted anew."""
    drawn = consolidated.where("like_count > 0").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "id")), "id").limit(n)
    anew = consolidate.likers(original.join(drawn.select("id"), "id", "left_semi")).select("id", F.col("liked_by_users").alias("counted"))
    out = drawn.join(anew, "id", "left").select("id", "like_count", "liked_by_users", "counted")
    return out.withColumn("agree", F.col("liked_by_users").eqNullSafe(F.col("counted")))


def verification(original: DataFrame, consolidated: DataFrame) -> dict[str, DataFrame]:
    """The whole report on a consolidation: what it kept, lost and inferred, its threads and who answers whom."""
    posts = consolidated.select("id", F.nullif("in_reply_to_status_id", F.lit("")).alias("parent_id"), F.col("user_screen_name").alias("author"), F.col("full_text").alias("text"), "created_at")
    return {
        "likers": liker_sample(original, consolidated), "thread_sizes": thread_size_stats(threads.direct_sizes(posts)), "hot_threads": threads.hot_threads(posts), "interactions": threads.interactions(posts),
        "counts": counts(original), "kept": counts(consolidated), "types": type_shares(original), "duplicates": duplicates(original), "type_pairs": type_pairs(original), "duplicate_rows": duplicate_rows(original),
        "missing_ids": missing_ids(original, consolidated), "gaps": gaps(consolidated), "most_liked": top_liked(consolidated),
    }


def inspection(tweets: DataFrame) -> dict[str, DataFrame]:
    """The whole report on a table of posts."""
    plain = tweets.select(*[c for c, t in tweets.dtypes if not t.startswith(("array", "map", "struct"))])
    return {"counts": counts(tweets), "types": type_shares(tweets), "archives": share_by(tweets, "archive_file"), "gaps": gaps(tweets), "nulls": null_checks(tweets), "replies": reply_stats(tweets), "table": table_profile(plain, "created_at")}
