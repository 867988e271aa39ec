"""The url table and reports on it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions import links


def url_table(posts: DataFrame) -> DataFrame:
    """One row for each distinct url of a post, taken apart.

    ``posts`` has ``username, tweet_id, tweet_created_at, full_text`` and
    ``entity_urls`` (array of strings).
    """
    every = F.array_distinct(F.array_union(links.found_in("full_text", links.PLAIN_LINK), F.filter("entity_urls", lambda u: u.isNotNull() & (u != ""))))
    rows = posts.select("username", "tweet_id", "tweet_created_at", F.explode(every).alias("url"))
    p = links.parts("url")
    none = lambda t: F.lit(None).cast(t)
    return rows.select(
        "username", "tweet_id", "tweet_created_at", "url", links.normalized(p["raw_domain"]).alias("domain"), *[p[k].alias(k) for k in ("raw_domain", "protocol", "path", "query", "fragment")],
        none("string").alias("title"), none("string").alias("description"), none("string").alias("content_type"), none("int").alias("status_code"), none("string").alias("error"),
    )


def with_content(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """Page results joined on, one fetch a distinct url."""
    fields = [c for c in ("title", "description", "content_type", "status_code", "error") if c in pages.columns]
    return urls.drop(*fields).join(pages.select("url", *fields).dropDuplicates(["url"]), "url", "left")


def resolved(urls: DataFrame, fetch: Callable, schema: str = "url string, resolved string") -> DataFrame:
    """Shortened urls followed by ``fetch`` (a ``mapInPandas`` function), each once."""
    short = urls.where(links.needs_resolving("url")).select("url").distinct()
    return urls.join(short.mapInPandas(fetch, schema), "url", "left").withColumn("is_resolved", F.col("resolved").isNotNull())


def domain_counts(urls: DataFrame, top: int | None = None) -> DataFrame:
    """Distinct urls a domain, most first."""
    d = F.regexp_replace(F.lower(links.parts("url")["raw_domain"]), r"^www\.", "")
    counted = urls.select("url").distinct().groupBy(d.alias("domain")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "domain")
    return counted.limit(top) if top else counted


def report(urls: DataFrame, by: str = "username") -> DataFrame:
    """Counts and rates for each account."""
    return urls.groupBy(by).agg(
        F.count("*").alias("urls"),
        F.count_distinct("url").alias("unique_urls"),
        F.count_distinct("domain").alias("unique_domains"),
        F.avg((F.coalesce(F.col("status_code") == 200, F.lit(False))).cast("double")).alias("success_rate"),
        F.avg(F.col("error").isNotNull().cast("double")).alias("error_rate"),
    )


def categories(urls: DataFrame) -> DataFrame:
    """Internal links, unresolved short links, and all others."""
    inside = links.is_internal("url")
    short = links.is_shortener("raw_domain")
    return urls.withColumn("category", F.when(inside, "internal").when(short, "unresolved").otherwise("external"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")
    return counted.limit(top) if top else counted


def overall(urls: DataFrame) -> DataFrame:
    """The report's first figures: rows, distinct urls, sites and accounts."""
    inside, short = links.is_internal("url"), links.is_shortener("raw_domain")
    return urls.agg(
        F.count("*").alias("urls"), F.count_distinct("url").alias("unique_urls"), F.count_distinct("domain").alias("unique_domains"), F.count_distinct("username").alias("accounts"),
        F.count_if(inside).alias("internal"), F.count_if(short).alias("unresolved"), F.count_if(~inside & ~short).alias("external"),
    )


def external_domains(urls: DataFrame, top: int = 20) -> DataFrame:
    """The most frequent sites linked to, without internal and short links."""
    return value_counts(categories(urls).where("category = 'external'"), "domain", top)


def fetch_pages(urls: DataFrame, fetched: DataFrame, fetch: Callable, schema: str) -> DataFrame:
    """Pages of the distinct urls that ``fetched (url)`` lacks, by ``fetch``.

    ``fetch`` is a ``mapInPandas`` function: one call a batch, so it can hold
    connections and limits of its own.
    """
    todo = urls.select("url").where(links.is_absolute("url")).distinct().join(fetched.select("url").distinct(), "url", "left_anti")
    return todo.withColumn("handler", links.handler("url")).mapInPandas(fetch, schema)


def fetch_records(pages: DataFrame) -> DataFrame:
    """Page results as JSON records under the digest of their url."""
    return pages.select(F.sha2("url", 256).alias("key"), F.to_json(F.struct(*pages.columns), {"ignoreNullFields": "false"}).alias("record"))
