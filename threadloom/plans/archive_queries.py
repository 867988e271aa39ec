"""Queries on archive documents made of the driver's events.

Each user becomes one archive, written as JSON text and read by the real
reader, beside a file that is no JSON. The SQL takes the rows from the events
themselves and knows nothing of documents.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import scalar
from threadloom.operators import profile, threads
from threadloom.operators.durable import shared_dir
from threadloom.plans import carriers
from threadloom.sources import archives, shapes, splittable, tails

POSTS = {"tweets": ("purchase", "error"), "community-tweet": ("view",), "note-tweet": ("signup",), "like": ("click",)}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``archive_file, raw``: an archive a user and a broken one."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    ident, text = F.col("event_id").cast("string"), F.concat("event_type", F.lit("\n"), "props")
    number = lambda n: (F.col("event_id") % n).cast("string")
    link = F.when(F.col("event_id") % 3 == 0, F.array(F.struct(F.concat(F.lit("https://e.org/"), ident).alias("expanded_url"))))
    tag = F.array(F.struct(F.concat(F.lit("t"), number(5)).alias("text")))
    answers = F.when(F.col("event_type") == "error", (F.col("event_id") - 1).cast("string"))
    post = F.struct(
        ident.alias("id_str"), text.alias("full_text"), F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at"), number(7).alias("favorite_count"), answers.alias("in_reply_to_status_id_str"),
        F.struct(link.alias("urls"), tag.alias("hashtags")).alias("entities"),
    )
    note = F.struct(ident.alias("noteTweetId"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("createdAt"), F.struct(text.alias("text"), tag.alias("hashtags")).alias("core"))
    even = F.col("event_id") % 2 == 0
    like = F.struct(F.when(even, ident).alias("tweetId"), F.when(~even, ident).alias("tWeetId"), text.alias("fullText"), F.when(even, F.concat(F.lit("https://x.org/"), ident)).alias("expandedUrl"))
    item = {"tweets": ("tweet", post), "community-tweet": ("tweet", post), "note-tweet": ("noteTweet", note), "like": ("like", like)}
    lists = [F.collect_list(F.when(F.col("event_type").isin(*kinds), F.struct(item[s][1].alias(item[s][0])))).alias(s) for s, kinds in POSTS.items()]
    user = F.col("user_id").cast("string")
    known = F.when(F.col("user_id") % 2 == 0, F.struct(user.alias("id"), F.concat(F.lit("n"), user).alias("userName"), F.concat(F.lit("Name "), user).alias("displayName")))
    profile_ = F.struct(known.alias("userInformations"), F.struct(F.concat(F.lit("bio of "), user).alias("bio")).alias("description"), F.concat(F.lit("https://e.org/p/"), user).alias("avatarMediaUrl"))
    account = F.struct(F.concat(F.lit("n"), user).alias("username"), user.alias("accountId"), F.concat(F.lit("Name "), user).alias("accountDisplayName"))
    meta = F.when(F.col("user_id") % 3 == 0, F.struct(F.concat(F.lit("tag"), user).alias("etag")))
    whole = F.struct(F.array(F.struct(account.alias("account"))).alias("account"), F.array(F.struct(profile_.alias("profile"))).alias("profile"), *[F.col(f"`{s}`") for s in POSTS], meta.alias("_metadata"))
    made = e.groupBy("user_id").agg(*lists).select(F.concat(F.lit("u"), user, F.lit("_archive.json")).alias("archive_file"), F.to_json(whole).alias("raw"))
    broken = spark.range(1).select(F.lit("broken_archive.json").alias("archive_file"), F.lit('{"tweets": [').alias("raw"))
    return made.unionByName(broken)


def _read(spark, sf) -> DataFrame:
    return archives.parse_archives(documents(spark, sf))


def archive_rows(spark, sf):
    return _flat(archives.source_tweets(_read(spark, sf)))


def _flat(rows: DataFrame) -> DataFrame:
    joined = [F.array_join(c, ",").alias(c) for c in ("urls", "hashtags")]
    names = ("id", "tweet_type", "user_id", "user_screen_name", "user_name", "full_text", "in_reply_to_status_id", "favorite_count", "favorited", "is_reply", "archive_file")
    return rows.select(*names, F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("created_at"), *joined)


def archive_conversion(spark, sf):
    return archives.converted(_read(spark, sf)).groupBy("tweet_type").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.max("archive_file").alias("last_file"))


def archive_accounts(spark, sf):
    return archives.accounts(_read(spark, sf))


def archive_owners(spark, sf):
    return archives.owners(_read(spark, sf)).select("archive_file", "user_id", "user_screen_name", "user_name")


def archive_profiles(spark, sf):
    return archives.profiles(_read(spark, sf))


def archive_quarantine(spark, sf):
    return archives.quarantined(_read(spark, sf)).select("archive_file", F.col("n_chars").cast("long").alias("n_chars"))


def archive_signatures(spark, sf):
    return archives.format_signatures(_read(spark, sf))


def archive_metadata(spark, sf):
    return archives.archive_metadata(_read(spark, sf))


def _folder(spark, sf) -> str:
    """The documents as files, one an archive, all in one folder.

    Tasks write them by their names. A folder of its own for each would cost a
    commit and a listing one by one.
    """
    path = f"{shared_dir(spark)}/threadloom/archives-{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
        store.create_dir(inner, recursive=True)
        for batch in batches:
            for name, raw in zip(batch.column(0), batch.column(1), strict=True):
                whole, part = f"{inner}/{name.as_py()}", f"{inner}/.{name.as_py()}-{uuid.uuid4().hex}"  # hidden until it is whole
                with store.open_output_stream(part) as out:
                    out.write(raw.as_py().encode("utf-8", "surrogatepass") + b"\n")
                store.move(part, whole)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    documents(spark, sf).repartition(n, "archive_file").mapInArrow(run, "n long").agg(F.sum("n")).collect()
    return path


def archive_file_rows(spark, sf):
    """From files on disk, by the splittable reader."""
    return _flat(splittable.source_tweets(splittable.read(spark, _folder(spark, sf))))


def archive_file_states(spark, sf):
    """Which files are archives, and whose."""
    found = splittable.read(spark, _folder(spark, sf)).archives
    return found.select("archive_file", "corrupt", F.when(~F.col("corrupt"), F.get(F.col("archive.account"), 0)["account"]["username"]).alias("username"))


def archive_shapes(spark, sf):
    """Places and kinds of all documents."""
    found = shapes.shapes(documents(spark, sf)).where("place like '$.%.%'")
    return found.select("place", "kind", "n", "documents", "optional", "conflict")


def archive_file_tails(spark, sf):
    """Metadata from the ends of files on disk."""
    return tails.archive_tails(spark, _folder(spark, sf)).select("archive_file", "metadata")


def archive_kinds(spark, sf):
    rows = archives.source_tweets(_read(spark, sf))
    each = [archives.rows_of_kind(rows, k).groupBy().agg(F.lit(k).alias("kind"), F.count("*").alias("n"), F.min("id").alias("first_id")) for k in archives.KINDS]
    return each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3])


def duplicate_rows(spark, sf):
    return profile.duplicate_rows(carriers.source(spark, sf), 20)


def version_counts(spark, sf):
    """Every row with how many rows share its id."""
    return profile.version_counts(carriers.source(spark, sf).select("id", "tweet_type", "archive_file", "full_text"))


def first_authors(spark, sf):
    """The first distinct authors of replies in the order of their names."""
    return profile.first_authors(carriers.source(spark, sf))


def hot_thread_members(spark, sf):
    found = threads.hot_members(carriers.threads(spark, sf), least=2)
    return found.select("thread_id", "id", "place", "author", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("created_at"))


def post_sample(spark, sf):
    """By digest: the SQL draws the same rows."""
    return profile.sample_of_type(carriers.source(spark, sf), "note_tweet", 20)


def table_profile(spark, sf):
    out = profile.table_profile(carriers.source(spark, sf).select("id", "user_id", "full_text", "created_at", "tweet_type", "archive_file"), "created_at")
    return out.select("n_rows", "unique_rows", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS").alias(c) for c in ("first_at", "last_at")], "with_at", "with_hash", "with_link")


def text_previews(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", scalar.preview("text", 40).alias("preview"))


Q = {f.__name__: f for f in (
    archive_rows, archive_conversion, archive_accounts, archive_owners, archive_profiles, archive_quarantine, archive_signatures, archive_metadata, archive_kinds,
    archive_file_rows, archive_file_states, archive_file_tails, archive_shapes,
    duplicate_rows, version_counts, first_authors, hot_thread_members, post_sample, table_profile, text_previews,
)}

_SRC = f"WITH src AS ({carriers.duck(carriers.SOURCE)})"
_THR = f"WITH thr AS ({carriers.duck(carriers.THREAD)})"
_MS = "'%Y-%m-%d %H:%M:%S.%g'"
_KIND = "CASE event_type WHEN 'click' THEN 'like' WHEN 'signup' THEN 'note_tweet' WHEN 'view' THEN 'community_tweet' ELSE 'tweet' END"
_USERS = "(SELECT DISTINCT user_id, CAST(user_id AS VARCHAR) AS u FROM events)"
_OWN = "'n' || user_id ELSE 'u' || user_id END"

SQL = {
    "archive_rows": f"""
SELECT CAST(event_id AS VARCHAR) AS id, {_KIND} AS tweet_type, CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE '' END AS user_id,
  CASE WHEN user_id % 2 = 0 THEN {_OWN} AS user_screen_name, CASE WHEN user_id % 2 = 0 THEN 'Name ' || user_id ELSE 'u' || user_id END AS user_name, event_type || chr(10) || props AS full_text,
  CASE WHEN event_type = 'error' THEN CAST(event_id - 1 AS VARCHAR) END AS in_reply_to_status_id,
  CAST(CASE WHEN event_type IN ('click', 'signup') THEN 0 ELSE event_id % 7 END AS INTEGER) AS favorite_count, event_type = 'click' AS favorited, event_type = 'error' AS is_reply,
  'u' || user_id || '_archive.json' AS archive_file,
  CASE event_type WHEN 'click' THEN NULL WHEN 'signup' THEN strftime(ts, {_MS}) ELSE strftime(date_trunc('second', ts), {_MS}) END AS created_at,
  CASE WHEN event_type = 'click' AND event_id % 2 = 0 THEN 'https://x.org/' || event_id WHEN event_type NOT IN ('click', 'signup') AND event_id % 3 = 0 THEN 'https://e.org/' || event_id ELSE '' END AS urls,
  CASE WHEN event_type = 'click' THEN '' ELSE 't' || (event_id % 5) END AS hashtags
FROM events""",
    "archive_conversion": f"""
SELECT replace({_KIND}, '_tweet', '') AS tweet_type, count(*) AS n, count(DISTINCT event_id) AS ids, max('u' || user_id || '_archive.json') AS last_file
FROM events WHERE event_type <> 'click' GROUP BY 1""",
    "archive_accounts": f"SELECT 'u' || u || '_archive.json' AS archive_file, 'n' || u AS username, u AS account_id, 'Name ' || u AS display_name FROM {_USERS}",
    "archive_owners": f"""
SELECT 'u' || u || '_archive.json' AS archive_file, CASE WHEN user_id % 2 = 0 THEN u ELSE '' END AS user_id, CASE WHEN user_id % 2 = 0 THEN {_OWN} AS user_screen_name,
  CASE WHEN user_id % 2 = 0 THEN 'Name ' || u ELSE 'u' || u END AS user_name FROM {_USERS}""",
    "archive_profiles": f"SELECT 'u' || u AS username, 'bio of ' || u AS bio, '' AS website, '' AS location, 'https://e.org/p/' || u AS avatar, '' AS header FROM {_USERS}",
    "archive_quarantine": "SELECT 'broken_archive.json' AS archive_file, CAST(12 AS BIGINT) AS n_chars",
    "archive_signatures": f"""
SELECT CASE WHEN user_id % 3 = 0 THEN '_metadata,' ELSE '' END || 'account,community-tweet,like,note-tweet,profile,tweets' AS signature, count(*) AS archives FROM {_USERS} GROUP BY 1""",
    "archive_metadata": f"SELECT 'u' || u || '_archive.json' AS archive_file, 'u' || u AS username, '{{\"etag\":\"tag' || u || '\"}}' AS metadata FROM {_USERS} WHERE user_id % 3 = 0",
    "archive_kinds": """
SELECT kind, count(event_id) AS n, min(CAST(event_id AS VARCHAR)) AS first_id
FROM (VALUES ('tweet', 'purchase'), ('tweet', 'error'), ('note', 'signup'), ('community', 'view'), ('like', 'click')) k(kind, type) LEFT JOIN events ON event_type = type GROUP BY kind""",
    "duplicate_rows": f"""{_SRC}, twice AS (SELECT id FROM src GROUP BY id HAVING count(*) > 1 ORDER BY md5(id), id LIMIT 20)
SELECT id, tweet_type, user_screen_name, archive_file, full_text FROM src WHERE id IN (SELECT id FROM twice)""",
    "version_counts": f"{_SRC} SELECT id, tweet_type, archive_file, full_text, count(*) OVER (PARTITION BY id) AS versions FROM src",
    "first_authors": f"{_SRC} SELECT DISTINCT user_screen_name, user_name FROM src WHERE is_reply ORDER BY 1, 2 LIMIT 25",
    "hot_thread_members": f"""{_THR}, hot AS (SELECT parent_id AS thread_id, count(*) AS n FROM thr WHERE parent_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, thread_id LIMIT 5)
SELECT thread_id, id, row_number() OVER (PARTITION BY thread_id ORDER BY created_at, id) AS place, author, strftime(created_at, {_MS}) AS created_at
FROM thr JOIN hot ON thr.parent_id = hot.thread_id OR thr.id = hot.thread_id""",
    "post_sample": f"""{_SRC} SELECT id, user_screen_name, left(full_text, 100) || '...' AS preview, archive_file FROM src WHERE tweet_type = 'note_tweet'
ORDER BY md5('7' || chr(31) || id || chr(31) || archive_file || chr(31) || full_text), id LIMIT 20""",
    "sample_posts": f"""{_SRC} SELECT id, user_screen_name, left(full_text, 100) || '...' AS preview, archive_file FROM src WHERE tweet_type = 'note_tweet'
ORDER BY md5('7' || chr(31) || id || chr(31) || archive_file || chr(31) || full_text), id LIMIT 5""",
    "table_profile": f"""{_SRC} SELECT count(*) AS n_rows, count(DISTINCT (id, user_id, full_text, created_at, tweet_type, archive_file)) AS unique_rows, strftime(min(created_at), {_MS}) AS first_at,
  strftime(max(created_at), {_MS}) AS last_at, count(*) FILTER (full_text LIKE '%@%') AS with_at, count(*) FILTER (full_text LIKE '%#%') AS with_hash, count(*) FILTER (full_text LIKE '%http%') AS with_link FROM src""",
    "text_previews": "SELECT doc_id, CASE WHEN text IS NULL THEN '[NULL]' ELSE left(text, 40) || '...' END AS preview FROM documents",
}
SQL["archive_file_rows"] = SQL["archive_rows"]
SQL["archive_file_states"] = f"""SELECT 'u' || u || '_archive.json' AS archive_file, false AS corrupt, 'n' || u AS username FROM {_USERS} UNION ALL SELECT 'broken_archive.json', true, NULL"""
SQL["archive_file_tails"] = f"""SELECT 'u' || u || '_archive.json' AS archive_file, CASE WHEN user_id % 3 = 0 THEN '{{"etag":"tag' || u || '"}}' END AS metadata FROM {_USERS} UNION ALL SELECT 'broken_archive.json', NULL"""
