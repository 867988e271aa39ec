"""The registered queries: every operator on the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import links, markup, scalar
from threadloom.operators import consolidate, exports, growing, identity, merging, profile, threads
from threadloom.operators import links as url_ops
from threadloom.operators.durable import shared_dir
from threadloom.plans import archive_queries, carriers

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = dict(archive_queries.Q)


def query(f):
    Q[f.__name__] = f
    return f


def _at(x: str | Column) -> Column:
    return F.date_format(x, "yyyy-MM-dd HH:mm:ss.SSS")


def _table(spark, sf, name) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def consolidated_posts(spark, sf):
    out = consolidate.consolidated(carriers.source(spark, sf))
    return out.select(
        "id", "user_id", "user_screen_name", "user_name", "tweet_type", "full_text", _at("created_at").alias("created_at"), "in_reply_to_status_id",
        F.array_join("liked_by_users", ",").alias("likers"), "like_count", _at("inferred_timestamp").alias("inferred_at"),
    )


@query
def likers(spark, sf):
    return consolidate.likers(carriers.source(spark, sf)).select("id", F.array_join("liked_by_users", ",").alias("likers"), "like_count")


@query
def best_versions(spark, sf):
    return consolidate.best_versions(carriers.source(spark, sf)).select("id", "tweet_type", "full_text", "archive_file", "user_id")


@query
def author_inference(spark, sf):
    return consolidate.inferred_authors(consolidate.best_versions(carriers.source(spark, sf)))


@query
def canonical_posts(spark, sf):
    c = consolidate.canonical(carriers.source(spark, sf))
    return c.select("id", "text", _at("created_at").alias("created_at"), "author_username", "in_reply_to_status_id", F.array_join("likers", ",").alias("likers"), F.array_join(F.transform("reply_ids", lambda x: x.cast("string")), ",").alias("replies"))


@query
def user_export(spark, sf):
    return consolidate.users(carriers.source(spark, sf))


@query
def top_users(spark, sf):
    counted = consolidate.users(carriers.source(spark, sf))
    return counted.orderBy(F.desc("tweet_count"), "user_id").limit(10).select("user_id", "user_screen_name", "tweet_count")


@query
def row_counts(spark, sf):
    return profile.counts(carriers.source(spark, sf))


@query
def type_shares(spark, sf):
    return profile.type_shares(carriers.source(spark, sf))


@query
def attribution_gaps(spark, sf):
    return profile.gaps(carriers.source(spark, sf))


@query
def null_checks(spark, sf):
    return profile.null_checks(carriers.source(spark, sf))


@query
def archive_distribution(spark, sf):
    return profile.share_by(carriers.source(spark, sf), "archive_file")


@query
def duplicate_ids(spark, sf):
    return profile.duplicates(carriers.source(spark, sf))


@query
def duplicate_type_pairs(spark, sf):
    return profile.type_pairs(carriers.source(spark, sf))


@query
def liked_and_full(spark, sf):
    return profile.liked_and_full(carriers.source(spark, sf))


@query
def like_distribution(spark, sf):
    return profile.like_distribution(consolidate.consolidated(carriers.source(spark, sf)))


@query
def timestamp_stats(spark, sf):
    return profile.time_stats(consolidate.consolidated(carriers.source(spark, sf)))


@query
def author_stats(spark, sf):
    return profile.author_stats(consolidate.consolidated(carriers.source(spark, sf)))


@query
def top_liked(spark, sf):
    return profile.top_liked(consolidate.consolidated(carriers.source(spark, sf)))


@query
def id_preservation(spark, sf):
    s = carriers.source(spark, sf)
    return profile.missing_ids(s, consolidate.best_versions(s))


@query
def reply_stats(spark, sf):
    return profile.reply_stats(carriers.source(spark, sf))


@query
def distinct_types(spark, sf):
    return profile.distinct_values(carriers.source(spark, sf), "tweet_type")


@query
def text_profile(spark, sf):
    return profile.text_profile(_table(spark, sf, "documents"), "source")


@query
def monthly_activity(spark, sf):
    return carriers.source(spark, sf).where("created_at is not null").groupBy(F.date_format(F.date_trunc("month", "created_at"), "yyyy-MM").alias("month"), "tweet_type").agg(F.count("*").alias("n"))


@query
def sample_posts(spark, sf):
    return profile.sample_of_type(carriers.source(spark, sf), "note_tweet", 5)


@query
def hot_threads(spark, sf):
    return threads.hot_threads(carriers.threads(spark, sf), 2, 10)


@query
def direct_thread_sizes(spark, sf):
    return profile.thread_size_stats(threads.direct_sizes(carriers.threads(spark, sf)))


@query
def conversation_threads(spark, sf):
    t = threads.direct_threads(carriers.threads(spark, sf))
    return t.select("root_id", "length", F.array_join(F.transform("replies", lambda r: r["id"].cast("string")), ",").alias("reply_ids"))


@query
def thread_closure(spark, sf):
    return threads.closure(carriers.threads(spark, sf))


@query
def thread_closure_batches(spark, sf):
    """The closure kept up to date over three batches, which cut through the threads."""
    posts = carriers.threads(spark, sf)
    folder = f"{shared_dir(spark)}/threadloom/growing-{uuid.uuid4().hex}"
    for k in range(3):
        growing.extend(posts.where(F.pmod(F.xxhash64("id"), F.lit(3)) == k), folder)
    return growing.closure(spark, folder)


@query
def thread_stats(spark, sf):
    s = threads.thread_stats(carriers.threads(spark, sf), 3)
    return s.select("root_id", "reply_count", "max_depth", "participants", _at("first_at").alias("first_at"), _at("last_at").alias("last_at"))


@query
def thread_paths(spark, sf):
    p = threads.paths(carriers.threads(spark, sf), 3)
    return p.select("root_id", "id", "depth", F.array_join(F.transform("path", lambda x: x.cast("string")), "/").alias("path"))


def _quotes(posts: DataFrame) -> DataFrame:
    q = links.quoted_id(F.array("quote_url"), F.col("id").cast("string"), F.lit(False), F.lit(None).cast("string"))
    return posts.where("quote_url is not null").select("id", q.alias("quoted_id")).where("quoted_id is not null")


@query
def quoted_posts(spark, sf):
    return _quotes(carriers.threads(spark, sf))


@query
def thread_trees(spark, sf):
    posts = carriers.threads(spark, sf)
    t = threads.trees(posts, _quotes(posts))
    listed = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return t.select("root_id", listed("descendant_ids"), listed("quoted_ids"), listed("quoting_ids"))


@query
def interaction_pairs(spark, sf):
    return threads.interactions(carriers.threads(spark, sf))


@query
def url_parts(spark, sf):
    p = links.parts("url")
    return _table(spark, sf, "pages").select("page_id", *[p[k].alias(k) for k in p])


@query
def domain_names(spark, sf):
    d = links.parts("url")["raw_domain"]
    pages = _table(spark, sf, "pages").select(d.alias("d"))
    extra = spark.createDataFrame([(x,) for x in DOMAIN_CASES], "d string")
    return pages.union(extra).select("d").distinct().select(F.col("d").alias("domain"), links.normalized("d").alias("site"), links.grouped("d").alias("site_group"), links.is_shortener("d").alias("shortener"))


DOMAIN_CASES = [
    "www.youtube.com", "youtu.be", "m.youtube.com", "x.com", "api.twitter.com", "subdomain.x.com", "en.wikipedia.org", "fr.wikipedia.org", "t.co", "bit.ly",
    "gist.github.com", "raw.githubusercontent.com", "a.medium.com", "medium.com", "b.substack.com", "WWW.Example.COM", "en.m.wikipedia.org", "m.github.com", "m.co",
]


@query
def domain_stats(spark, sf):
    return url_ops.domain_counts(_table(spark, sf, "pages"))


@query
def url_table(spark, sf):
    posts = carriers.threads(spark, sf).select(
        F.col("author").alias("username"), F.col("id").cast("string").alias("tweet_id"), F.col("created_at").alias("tweet_created_at"),
        F.concat(F.lit("see http://www.example.com/a;b?x="), F.col("id").cast("string"), F.lit(" and https://youtu.be/v"), (F.col("id") % 9).cast("string")).alias("full_text"), F.array("quote_url").alias("entity_urls"),
    )
    return url_ops.url_table(posts).select("username", "tweet_id", "url", "domain", "raw_domain", "protocol", "path", "query", "fragment")


@query
def url_extract(spark, sf):
    text = F.concat(F.lit("see https://t.co/abc"), F.col("doc_id").cast("string"), F.lit(", https://www.twitter.com/ann/status/"), F.col("doc_id").cast("string"), F.lit("?s=20 or http://a.b/c%20d"))
    return _table(spark, sf, "documents").select("doc_id", F.array_join(links.found_in(text), " ").alias("found"))


def _url_cases(spark, sf) -> DataFrame:
    i = F.col("doc_id").cast("string")
    one = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in p])
    n = F.col("doc_id") % 9
    url = (
        F.when(n == 0, one("https://www.youtube.com/watch?v=v_", i)).when(n == 1, one("https://youtu.be/s-", i)).when(n == 2, one("https://youtube.com/shorts/q", i))
        .when(n == 3, one("https://x.com/ann/status/", i, "?a=1")).when(n == 4, one("https://twitter.com/bob/statuses/", i)).when(n == 5, one("https://github.com/own", i, "/repo"))
        .when(n == 6, one("https://instagram.com/reel/r", i, "/")).when(n == 7, one("https://t.co/", i)).otherwise(one("https://m.twitter.com/cid/status/", i))
    )
    return _table(spark, sf, "documents").select("doc_id", url.alias("url"))


@query
def id_extractors(spark, sf):
    return _url_cases(spark, sf).select("doc_id", links.video_id("url").alias("video"), links.post_id("url").alias("post"), links.repo_owner("url").alias("owner"), links.repo_name("url").alias("repo"), links.photo_id("url").alias("photo"), links.handler("url").alias("handler"))


@query
def url_categories(spark, sf):
    cases = _url_cases(spark, sf).withColumn("raw_domain", links.parts("url")["raw_domain"])
    return profile.share_by(url_ops.categories(cases), "category")


@query
def archive_url_stats(spark, sf):
    cases = _url_cases(spark, sf)
    rows = cases.select(
        (F.col("doc_id") % 5).cast("string").alias("username"), "url", links.normalized(links.parts("url")["raw_domain"]).alias("domain"),
        F.when(F.col("doc_id") % 3 == 0, 200).when(F.col("doc_id") % 3 == 1, 404).alias("status_code"), F.when(F.col("doc_id") % 3 == 1, "HTTP 404").alias("error"),
    )
    out = url_ops.report(rows)
    return out.withColumns({"success_rate": F.round("success_rate", 6), "error_rate": F.round("error_rate", 6)})


@query
def fetch_states(spark, sf):
    cases = _url_cases(spark, sf).withColumn("content_type", F.when(F.col("doc_id") % 4 == 0, "image/png").when(F.col("doc_id") % 4 == 1, "application/json").otherwise("text/html; charset=utf-8"))
    code = F.when(F.col("doc_id") % 3 == 0, 200).when(F.col("doc_id") % 3 == 1, 404)
    skipped = links.skip_reason("url", "content_type")
    return cases.select("doc_id", F.coalesce(skipped, F.lit("-")).alias("skipped"), links.fetch_status(code, F.when(F.col("doc_id") % 3 == 1, "x"), skipped).alias("status"))


@query
def clean_texts(spark, sf):
    t = F.concat(F.lit("@ann "), F.col("text"), F.lit("  #tag https://t.co/x "), F.lit("end"))
    return _table(spark, sf, "documents").select("doc_id", F.md5(scalar.clean_text(t)).alias("clean_md5"), F.size(scalar.words(t)).cast("long").alias("n_tokens"))


@query
def text_entities(spark, sf):
    t = F.concat(F.lit("@ann and @bob_1 #one #two "), F.lit("@u"), (F.col("doc_id") % 3).cast("string"))
    return _table(spark, sf, "documents").select("doc_id", F.array_join(scalar.marked_words(t, "@"), ",").alias("mentions"), F.array_join(scalar.marked_words(t, "#"), ",").alias("hashtags"))


@query
def id_times(spark, sf):
    s = carriers.source(spark, sf).select("id").distinct().withColumn("bad", F.concat("id", F.lit("x")))
    return s.select("id", scalar.valid_id("id").alias("valid"), scalar.valid_id("bad").alias("bad_valid"), _at(scalar.snowflake_time("id")).alias("made_at"))


@query
def parsed_times(spark, sf):
    e = _table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    a = F.date_format("ts", "'Mon' MMM dd HH:mm:ss '+0000' yyyy")
    b = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return e.select("event_id", _at(scalar.archive_time(a)).alias("from_post"), _at(scalar.archive_time(b)).alias("from_note"), scalar.archive_time(F.lit("garbage")).isNull().alias("bad_is_null"))


@query
def identity_history(spark, sf):
    return identity.history(carriers.identity(spark, sf), "display_name").select("user_id", _at("ts").alias("ts"), "value")


@query
def identity_as_of(spark, sf):
    log = carriers.identity(spark, sf)
    mid = F.lit("2024-01-16").cast("timestamp")
    return identity.as_of(log, mid).select("user_id", "username", "display_name", "avatar_url", _at("changed_at").alias("changed_at"))


@query
def identity_as_of_each(spark, sf):
    log = carriers.identity(spark, sf)
    asked = log.select("user_id", F.col("ts").alias("at"), F.col("seq").alias("event_id"))
    return identity.as_of_each(asked, log).select("event_id", "user_id", "username", "display_name", "avatar_url")


@query
def identity_latest(spark, sf):
    return identity.latest(carriers.identity(spark, sf))


@query
def identity_temporary(spark, sf):
    log = carriers.identity(spark, sf).withColumn("user_id", F.when(F.col("seq") % 4 == 0, None).otherwise(F.col("user_id")))
    w = identity.with_ids(log)
    return w.select("seq", "user_id", "display_name", scalar.is_temporary("user_id").alias("temporary"))


@query
def export_markdown(spark, sf):
    return exports.markdown(carriers.threads(spark, sf)).select("id", F.md5("line").alias("md5"))


@query
def export_markdown_threads(spark, sf):
    return exports.markdown_thread(threads.direct_threads(carriers.threads(spark, sf))).select("root_id", F.md5("line").alias("md5"))


@query
def export_jsonl(spark, sf):
    return exports.jsonl_thread(threads.direct_threads(carriers.threads(spark, sf))).select("root_id", F.md5("line").alias("md5"))


@query
def export_chat(spark, sf):
    return exports.chat_thread(threads.direct_threads(carriers.threads(spark, sf))).select("root_id", F.md5("line").alias("md5"))


@query
def export_training(spark, sf):
    return exports.training_thread(threads.direct_threads(carriers.threads(spark, sf))).select("root_id", F.md5("line").alias("md5"))


@query
def export_posts(spark, sf):
    return exports.jsonl(carriers.threads(spark, sf)).select("id", F.md5("line").alias("md5"))


def _linked(spark, sf) -> DataFrame:
    pages = _table(spark, sf, "pages")
    return pages.select("page_id", F.replace("html", F.lit('href="/'), F.lit('href="https://example.net/')).alias("html"))


@query
def html_titles(spark, sf):
    return _table(spark, sf, "pages").select("page_id", markup.title_of(F.col("html")).alias("title"))


@query
def html_links(spark, sf):
    found = markup.links_of(F.col("html"))
    return _linked(spark, sf).select("page_id", F.size(found).cast("long").alias("n_links"), F.md5(F.array_join(found, "\n")).alias("links_md5"))


@query
def html_pages(spark, sf):
    return _linked(spark, sf).select("page_id", markup.page_of("html").alias("p")).select("page_id", "p.*")


@query
def merged_archives(spark, sf):
    ids = consolidate.best_versions(carriers.source(spark, sf)).select("id", "tweet_type", "full_text")
    k = F.pmod(F.length("id") + F.substr("id", F.lit(-4)).cast("int"), F.lit(3))
    old, new = ids.where(k != 0), ids.where(k != 2).withColumn("full_text", F.concat("full_text", F.lit("*")))
    return merging.merge_rows(old, new)


@query
def merge_statistics(spark, sf):
    ids = consolidate.best_versions(carriers.source(spark, sf)).select("id", "tweet_type")
    k = F.pmod(F.length("id") + F.substr("id", F.lit(-4)).cast("int"), F.lit(3))
    old, new = ids.where(k != 0), ids.where(k != 2)
    return merging.merge_stats(old, new, merging.merge_rows(old, new))


@query
def safe_user_names(spark, sf):
    return _table(spark, sf, "customer").select("c_custkey", scalar.safe_name("c_name").alias("safe"))


@query
def not_processed(spark, sf):
    from threadloom.sources import archives

    found = carriers.source(spark, sf).select("archive_file").distinct()
    return archives.not_processed(found, found.where("archive_file < 'a2'"))


@query
def section_union(spark, sf):
    s = carriers.source(spark, sf)
    parts = [s.where(F.col("tweet_type") == k).select("id", F.lit(n).alias("kind")) for k, n in (("tweet", "tweet"), ("note_tweet", "note"), ("community_tweet", "community"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).where("id is not null").groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


@query
def url_report(spark, sf):
    return url_ops.overall(_report_rows(spark, sf))


@query
def external_domains(spark, sf):
    return url_ops.external_domains(_report_rows(spark, sf))


def _report_rows(spark, sf) -> DataFrame:
    d = links.parts("url")["raw_domain"]
    return _url_cases(spark, sf).select((F.col("doc_id") % 5).cast("string").alias("username"), "url", d.alias("raw_domain"), links.normalized(d).alias("domain"))


@query
def array_lengths(spark, sf):
    s = carriers.source(spark, sf).groupBy("user_id", "tweet_type").agg(F.to_json(F.array_sort(F.collect_set("id"))).alias("ids"))
    return profile.array_lengths(s, "ids", "tweet_type")


@query
def rows_by_parameter(spark, sf):
    return profile.rows_with(carriers.source(spark, sf), "tweet_type", "like").select("id", "user_id")


@query
def interaction_scores(spark, sf):
    from threadloom.operators import similarity

    s = carriers.source(spark, sf)
    kind = F.when(F.col("tweet_type") == "like", "mention").when(F.col("is_reply"), "reply").when(F.col("tweet_type") == "note_tweet", "quote").otherwise("other")
    edges = s.select((F.col("user_id").cast("long") % 20).alias("source"), (F.length("full_text") % 7 + F.col("favorite_count")).cast("long").alias("target"), kind.alias("kind"))
    return similarity.interaction_scores(edges)


@query
def user_similarity(spark, sf):
    """Sources as users, by all that their documents say."""
    from threadloom.operators import similarity

    posts = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("source").alias("user"), F.col("doc_id").alias("id"), "text")
    return similarity.user_similarity(posts, threshold=0.95)
