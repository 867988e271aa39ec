"""Reply threads: direct replies, closures, trees, quote graph, interactions.

Input everywhere is a table of posts with ``id``, ``parent_id`` and ``author``;
ids must be unique (see ``consolidate.best_versions``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.durable import written


def direct_threads(posts: DataFrame) -> DataFrame:
    """Roots without parent that have replies, with their direct replies in time."""
    replies = posts.where("parent_id is not null").groupBy(F.col("parent_id").alias("root_id")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("created_at").isNotNull().alias("dated"), F.col("created_at").alias("at"), "id", "text"))).alias("replies")
    ).withColumn("replies", F.transform("replies", lambda r: r.dropFields("dated")))  # undated ones came first
    roots = posts.where("parent_id is null").select(F.col("id").alias("root_id"), F.col("text").alias("root_text"), F.col("created_at").alias("root_at"))
    return roots.join(replies, "root_id").withColumn("length", (F.size("replies") + 1).cast("long"))


def closure(posts: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``root_id, id, depth`` of every post below each root, the root included.

    A root has replies, and no parent in the data. Ancestors are found by
    pointer jumping: each round a post's ancestor is replaced by that one's
    ancestor, so log2(depth) joins reach every root, and each join has one row
    an id on one side, whatever the fan-out. A round that settles no further
    post leaves only cycles and what hangs below them; they have no root and
    are left out. Rounds are written tables: the lineage stays short.
    """
    ids = posts.select(F.col("id").alias("pid"))
    start = posts.select("id", "parent_id").join(ids, F.col("parent_id") == F.col("pid"), "left")
    ups = written(start.select("id", F.coalesce("pid", "id").alias("up"), F.col("pid").isNotNull().cast("long").alias("steps"), F.col("pid").isNull().alias("done")), "closure")
    open_ = None
    while True:
        # a post is done once its ancestor is a root: roots are done with 0 steps
        up = ups.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("more"), (F.col("steps") == 0).alias("root"))
        step = ups.where("not done").join(up, "up").select("id", F.col("up2").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), F.col("root").alias("done"))
        ups = written(ups.where("done").unionByName(step), "closure")
        left = ups.where("not done").count()
        if left == 0 or left == open_:
            break
        open_ = left
    below = ups.where("done and steps > 0").select(F.col("up").alias("root_id"), "id", F.col("steps").alias("depth"))
    own = below.select("root_id").distinct().select("root_id", F.col("root_id").alias("id"), F.lit(0).cast("long").alias("depth"))
    out = own.unionByName(below)
    return out.where(F.col("depth") <= max_depth) if max_depth is not None else out


def thread_stats(posts: DataFrame, more_than: int = 0) -> DataFrame:
    """Size, depth, participants and time span of each thread."""
    members = closure(posts).join(posts.select("id", "author", "created_at"), "id")
    return (
        members.groupBy("root_id")
        .agg(
            (F.count("*") - 1).alias("reply_count"),
            F.max("depth").alias("max_depth"),
            F.count_distinct("author").alias("participants"),
            F.min("created_at").alias("first_at"),
            F.max("created_at").alias("last_at"),
        )
        .where(F.col("reply_count") + 1 > more_than)
    )


def paths(posts: DataFrame, depth: int = 3) -> DataFrame:
    """``root_id, id, depth, path`` down to a depth, by that many joins."""
    ids = posts.select(F.col("id").alias("pid"))
    kids = posts.select("id", "parent_id").where("parent_id is not null and parent_id <> id")
    missing = posts.join(ids, posts.parent_id == ids.pid, "left").where("pid is null").select("id")
    level = missing.join(kids.select(F.col("parent_id").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("root_id"), "id", F.lit(0).alias("depth"), F.array("id").alias("path"))
    out = level
    for d in range(1, depth + 1):
        level = level.select("root_id", F.col("id").alias("parent_id"), "path").join(kids, "parent_id").select("root_id", "id", F.lit(d).alias("depth"), F.array_append("path", F.col("id")).alias("path"))
        out = out.unionByName(level)
    return out


def trees(posts: DataFrame, quotes: DataFrame) -> DataFrame:
    """``root_id, descendant_ids, quoted_ids, quoting_ids`` of each thread.

    ``quotes`` are edges ``(id, quoted_id)``: what members quote, and who
    quotes members.
    """
    members = written(closure(posts).select("root_id", "id"), "members")
    below = members.where("id <> root_id").groupBy("root_id").agg(F.array_sort(F.collect_set("id")).alias("descendant_ids"))
    out = members.join(quotes, "id").groupBy("root_id").agg(F.array_sort(F.collect_set("quoted_id")).alias("quoted_ids"))
    into = members.join(quotes.select(F.col("quoted_id").alias("id"), F.col("id").alias("by")), "id").groupBy("root_id").agg(F.array_sort(F.collect_set("by")).alias("quoting_ids"))
    none = F.array().cast(posts.select(F.array("id").alias("a")).schema["a"].dataType)
    return below.join(out, "root_id", "left").join(into, "root_id", "left").select("root_id", "descendant_ids", F.coalesce("quoted_ids", none).alias("quoted_ids"), F.coalesce("quoting_ids", none).alias("quoting_ids"))


def direct_sizes(posts: DataFrame) -> DataFrame:
    """Direct replies of every root that has some."""
    ids = posts.select(F.col("id").alias("pid"))
    roots = posts.join(ids, posts.parent_id == ids.pid, "left").where("pid is null").select(F.col("id").alias("root_id"))
    counted = posts.where("parent_id is not null").groupBy(F.col("parent_id").alias("root_id")).agg(F.count("*").alias("replies"))
    return roots.join(counted, "root_id")


def hot_threads(posts: DataFrame, least: int = 5, top: int = 5) -> DataFrame:
    """The posts with most direct replies."""
    counted = posts.where("parent_id is not null").groupBy(F.col("parent_id").alias("thread_id")).agg(F.count("*").alias("reply_count"))
    return counted.where(F.col("reply_count") >= least).orderBy(F.desc("reply_count"), "thread_id").limit(top)


def hot_members(posts: DataFrame, least: int = 5, top: int = 5) -> DataFrame:
    """Posts of the hottest threads, the parent among them, with their place in time."""
    hot = F.broadcast(hot_threads(posts, least, top).select("thread_id"))  # top rows
    replies = posts.join(hot, posts.parent_id == F.col("thread_id"))
    both = replies.unionByName(posts.join(hot, posts.id == F.col("thread_id")))
    return both.withColumn("place", F.row_number().over(Window.partitionBy("thread_id").orderBy("created_at", "id")).cast("long"))


def interactions(posts: DataFrame) -> DataFrame:
    """Who answers whom: counts of replies, cross-user ones and distinct pairs."""
    parents = posts.select(F.col("id").alias("parent_id"), F.col("author").alias("parent_author"))
    pairs = posts.where("parent_id is not null").join(parents, "parent_id", "left")
    other = F.col("author") != F.col("parent_author")
    return pairs.agg(F.count("*").alias("replies"), F.count_if(other).alias("cross_user_replies"), F.count_distinct(F.when(F.col("parent_author").isNotNull(), F.concat_ws("->", "author", "parent_author"))).alias("pairs"))
