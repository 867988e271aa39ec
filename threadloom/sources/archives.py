"""Account archives: tolerant JSON reading and flattening.

One archive is one JSON object; files are read whole and parsed against an
explicit schema, so a malformed file becomes a quarantined row, not a failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.functions import scalar

SECTIONS = ("tweets", "community-tweet", "note-tweet", "like")


def read_archives(spark: SparkSession, path: str, glob: str = "*_archive.json") -> DataFrame:
    """``archive_file, username, archive, raw, corrupt`` of every file under ``path``."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    files = raw.select(F.col("_metadata.file_name").alias("archive_file"), F.col("value").alias("raw"))
    return parse_archives(files)


def parse_archives(files: DataFrame) -> DataFrame:
    repaired = F.replace("raw", F.lit('"tWeetId"'), F.lit('"tweetId"'))  # some archives misspell it
    parsed = F.from_json(repaired, schemas.ARCHIVE, {"mode": "PERMISSIVE"})
    shape = F.try_parse_json("raw")
    return files.select(
        "archive_file",
        scalar.user_of_file("archive_file").alias("username"),
        parsed.alias("archive"),
        "raw",
        (shape.isNull() | ~F.coalesce(F.schema_of_variant(shape).startswith("OBJECT"), F.lit(False))).alias("corrupt"),
        *[c for c in files.columns if c not in ("archive_file", "raw")],
    )


def quarantined(archives: DataFrame) -> DataFrame:
    return archives.where("corrupt").select("archive_file", F.length("raw").alias("n_chars"))


def _filled(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def accounts(archives: DataFrame) -> DataFrame:
    """Account of each archive: the first entry of its account section."""
    a = F.get(F.col("archive.account"), 0)["account"]
    return archives.where("not corrupt").select("archive_file", a["username"].alias("username"), a["accountId"].alias("account_id"), a["accountDisplayName"].alias("display_name"))


def owners(archives: DataFrame) -> DataFrame:
    """``archive_file, archive, user_id, user_screen_name, user_name`` of each archive.

    From the profile's user informations, else its own fields, else its
    handle, else the file's name; a missing name is the screen name.
    """
    outer = F.get(F.col("archive.profile"), 0)
    p = lambda *path: F.coalesce(*[_filled(_at(o, path)) for o in (outer["profile"], outer)])
    by_file = F.regexp_replace("archive_file", r"_archive\.json", "")
    screen = F.coalesce(
        p("userInformations", "userName"), p("userName"), p("screen_name"), _filled(F.regexp_replace(p("handle"), "^@+", "")), F.when(outer.isNotNull(), by_file), F.lit("")
    )
    ident = F.coalesce(p("userInformations", "id"), p("id"), F.lit(""))
    name = F.coalesce(p("userInformations", "displayName"), p("displayName"), p("name"), _filled(screen), F.lit(""))
    path = ["path"] if "path" in archives.columns else []
    return archives.where("not corrupt").select(*path, "archive_file", "archive", by_file.alias("by_file"), ident.alias("user_id"), screen.alias("user_screen_name"), name.alias("user_name"))


def _at(x: Column, path: tuple[str, ...]) -> Column:
    for p in path:
        x = x[p]
    return x


def _exploded(owned: DataFrame, section: str, wrapper: str, entries: DataFrame | None = None) -> DataFrame:
    """Owners beside each entry ``p`` of a section: in the archive, and in ``entries (path, section, text)``."""
    own = ["archive_file", "by_file", "user_id", "user_screen_name", "user_name"]
    every = owned.select(*own, F.explode(F.col(f"archive.`{section}`")).alias("e"))
    if entries is not None:
        kind = schemas.ARCHIVE[section].dataType.elementType
        cut = entries.where(F.col("section") == section).join(owned.select("path", *own), "path")
        every = every.unionByName(cut.select(*own, F.from_json("text", kind, {"mode": "PERMISSIVE"}).alias("e")))
    return every.select(*own, F.col(f"e.{wrapper}").alias("p")).where("p is not null")


def _or_empty(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def _texts(items: Column, pick) -> Column:
    none = F.array().cast("array<string>")
    return F.coalesce(F.filter(F.transform(items, pick), lambda x: x.isNotNull() & (x != "")), none)


def _row(kind: str, **columns) -> list[Column]:
    """The 23 columns in order; what is not given is null, false, 0 or empty."""
    empty = F.array().cast("array<string>")
    base = {
        "in_reply_to_status_id": F.lit(None), "in_reply_to_user_id": F.lit(None), "in_reply_to_screen_name": F.lit(None), "retweet_count": F.lit(0),
        "favorite_count": F.lit(0), "lang": F.lit(None), "source": F.lit(None), "created_at": F.lit(None), "favorited": F.lit(False), "retweeted": F.lit(False),
        "possibly_sensitive": F.lit(False), "urls": empty, "media": empty, "hashtags": empty, "user_mentions": empty, "is_reply": F.lit(False),
        "user_id": F.col("user_id"), "user_screen_name": F.col("user_screen_name"), "user_name": F.col("user_name"), "archive_file": F.col("archive_file"),
        "tweet_type": F.lit(kind),
    } | columns
    return [base[f.name].cast(f.dataType).alias(f.name) for f in schemas.SOURCE_TWEETS]


def _posts(owned: DataFrame, section: str, kind: str, entries: DataFrame | None = None) -> DataFrame:
    p = F.col("p")
    count = lambda x: F.coalesce(x.try_cast("int"), F.lit(0))
    return _exploded(owned, section, "tweet", entries).select(
        *_row(
            kind, id=_or_empty(p["id_str"]), user_screen_name=F.coalesce(_filled(F.col("user_screen_name")), F.col("by_file")),
            in_reply_to_status_id=p["in_reply_to_status_id_str"], in_reply_to_user_id=p["in_reply_to_user_id_str"], in_reply_to_screen_name=p["in_reply_to_screen_name"],
            retweet_count=count(p["retweet_count"]), favorite_count=count(p["favorite_count"]), full_text=_or_empty(p["full_text"]), lang=_or_empty(p["lang"]),
            source=_or_empty(p["source"]), created_at=scalar.archive_time(p["created_at"]), favorited=F.coalesce(p["favorited"], F.lit(False)),
            retweeted=F.coalesce(p["retweeted"], F.lit(False)), possibly_sensitive=F.coalesce(p["possibly_sensitive"], F.lit(False)),
            urls=_texts(p["entities"]["urls"], lambda u: u["expanded_url"]), media=_texts(p["extended_entities"]["media"], lambda m: m["media_url"]),
            hashtags=_texts(p["entities"]["hashtags"], lambda h: h["text"]), user_mentions=_texts(p["entities"]["user_mentions"], lambda m: m["screen_name"]),
            is_reply=p["in_reply_to_status_id_str"].isNotNull(),
        )
    )


def _notes(owned: DataFrame, entries: DataFrame | None = None) -> DataFrame:
    p, core = F.col("p"), F.col("p.core")
    tag = lambda h: F.coalesce(F.get_json_object(h, "$.text"), h)
    return _exploded(owned, "note-tweet", "noteTweet", entries).select(
        *_row(
            "note_tweet", id=_or_empty(p["noteTweetId"]), full_text=_or_empty(core["text"]), created_at=scalar.archive_time(p["createdAt"]),
            urls=_texts(core["urls"], lambda u: F.coalesce(u["expandedUrl"], u["expanded_url"])), hashtags=_texts(core["hashtags"], tag),
            user_mentions=_texts(core["mentions"], lambda m: m["screenName"]),
        )
    )


def _likes(owned: DataFrame, entries: DataFrame | None = None) -> DataFrame:
    """Likes name the account that likes, not the author."""
    p = F.col("p")
    link = _filled(p["expandedUrl"])
    none = F.array().cast("array<string>")
    return _exploded(owned, "like", "like", entries).select(
        *_row("like", id=_or_empty(p["tweetId"]), full_text=_or_empty(p["fullText"]), favorited=F.lit(True), urls=F.when(link.isNotNull(), F.array(link)).otherwise(none))
    )


def source_tweets(archives: DataFrame) -> DataFrame:
    """All posts and likes of all archives as rows of 23 columns."""
    return rows_of(owners(archives))


def rows_of(owned: DataFrame, entries: DataFrame | None = None) -> DataFrame:
    """Rows of the archives of ``owners`` and of entries that were cut out of them."""
    posts = _posts(owned, "tweets", "tweet", entries).unionByName(_posts(owned, "community-tweet", "community_tweet", entries))
    return posts.unionByName(_notes(owned, entries)).unionByName(_likes(owned, entries))


def converted(archives: DataFrame) -> DataFrame:
    """The one-shot conversion: posts, notes and community posts with an id."""
    kinds = F.when(F.col("tweet_type") == "note_tweet", "note").when(F.col("tweet_type") == "community_tweet", "community").otherwise("tweet")
    return source_tweets(archives).where("tweet_type <> 'like' and id <> ''").withColumn("tweet_type", kinds)


def usernames(spark: SparkSession, path: str) -> DataFrame:
    """Distinct names of a list: trimmed, lower-case, no blanks."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("username")).where("username <> ''").distinct()


def archive_metadata(archives: DataFrame) -> DataFrame:
    return archives.select("archive_file", "username", F.get_json_object("raw", "$._metadata").alias("metadata")).where("metadata is not null")


def not_processed(found: DataFrame, manifest: DataFrame, key: str = "archive_file") -> DataFrame:
    """Rows of ``found`` whose key no manifest row has; the manifest is append-only."""
    return found.join(manifest.select(key).distinct(), key, "left_anti")


def fetch_log(spark: SparkSession, path: str) -> DataFrame:
    """Last successful fetch of each url in a log of ``url,timestamp,status`` lines."""
    log = spark.read.schema("url string, ts string, status string").csv(path)
    return log.where("status = 'success'").groupBy("url").agg(F.max(F.try_to_timestamp("ts")).alias("fetched_at"))


def fresh(cache: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Cached pages not older than ``days``."""
    return cache.where(F.col("fetch_time") >= now - F.make_interval(days=F.lit(days)))


def format_signatures(archives: DataFrame) -> DataFrame:
    """How many archives have which set of sections, most frequent first."""
    keys = F.array_join(F.array_sort(F.json_object_keys("raw")), ",")
    return archives.where("not corrupt").groupBy(keys.alias("signature")).agg(F.count("*").alias("archives")).orderBy(F.desc("archives"), "signature")


KINDS = {"tweet": ("tweet",), "note": ("note_tweet",), "community": ("community_tweet",), "like": ("like",)}


def rows_of_kind(tweets: DataFrame, kind: str) -> DataFrame:
    """Rows of one kind of post by its short name."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind of post: {kind}")
    return tweets.where(F.col("tweet_type").isin(*KINDS[kind]))


def profiles(archives: DataFrame) -> DataFrame:
    """Profile texts and pictures of each account; what is missing is ''."""
    outer = F.get(F.col("archive.profile"), 0)
    p = lambda *path: _or_empty(F.coalesce(*[_filled(_at(o, path)) for o in (outer["profile"], outer)]))
    return archives.where("not corrupt").select(
        "username", p("description", "bio").alias("bio"), p("description", "website").alias("website"), p("description", "location").alias("location"), p("avatarMediaUrl").alias("avatar"), p("headerMediaUrl").alias("header")
    )


def typed_entities(entities: Column) -> Column:
    """Entities with numbers as numbers and missing link texts filled in."""
    ints = lambda xs: F.transform(xs, lambda i: i.try_cast("int"))
    return F.struct(
        F.transform(entities["urls"], lambda u: F.struct(u["url"].alias("url"), F.coalesce(u["expanded_url"], u["url"]).alias("expanded_url"), F.coalesce(u["display_url"], u["url"]).alias("display_url"), ints(u["indices"]).alias("indices"))).alias("urls"),
        F.transform(entities["hashtags"], lambda h: F.struct(h["text"].alias("text"), ints(h["indices"]).alias("indices"))).alias("hashtags"),
        F.transform(entities["user_mentions"], lambda m: F.struct(m["screen_name"].alias("screen_name"), m["name"].alias("name"), F.coalesce(m["id_str"], m["id"]).try_cast("bigint").alias("id"), ints(m["indices"]).alias("indices"))).alias("user_mentions"),
    )


def typed_media(media: Column) -> Column:
    """Media with the sizes as a map of numbers."""
    size = lambda _, s: F.struct(s["w"].try_cast("int").alias("w"), s["h"].try_cast("int").alias("h"), s["resize"].alias("resize"))
    return F.transform(media, lambda m: F.struct(m["type"].alias("type"), m["media_url"].alias("media_url"), F.transform_values(m["sizes"], size).alias("sizes")))


def structure(archives: DataFrame) -> DataFrame:
    """The schema found in each section over all archives, as text."""
    one = archives.where("not corrupt").agg(*[F.schema_of_variant_agg(F.try_variant_get(F.parse_json("raw"), f"$['{s}'][0]", "variant")).alias(s) for s in SECTIONS])
    return one.unpivot([], list(SECTIONS), "section", "found")


def sampled(archives: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """A repeatable sample of archives: the smallest hashes."""
    return archives.orderBy(F.xxhash64(F.lit(seed), "archive_file"), "archive_file").limit(n)
