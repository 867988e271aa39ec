import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.operators import consolidate, exports, merging
from threadloom.sources import archives, sinks
from threadloom.streaming import incremental


def post(i, text="t", at="Wed Oct 10 20:19:24 +0000 2018", **kw):
    return {"tweet": {"id_str": i, "full_text": text, **({"created_at": at} if at else {}), "favorite_count": "2", "retweet_count": "x", "lang": "en", "entities": {"urls": [], "hashtags": [], "user_mentions": []}, **kw}}


ANN = {
    "account": [{"account": {"username": "ann", "accountId": "1", "accountDisplayName": "Ann"}}],
    "profile": [{"profile": {"description": {"bio": "b"}, "userName": "ann_s", "id": "11", "displayName": "Ann S"}}],
    "tweets": [
        post("100", "hello @bob #x https://t.co/a", entities={"urls": [{"url": "https://t.co/a", "expanded_url": "https://e.x/a"}], "hashtags": [{"text": "x"}], "user_mentions": [{"screen_name": "bob", "id": 3}]}),
        post("101", "reply", at=None, in_reply_to_status_id_str="100", in_reply_to_screen_name="ann_s"),
        {"other": {}}, {"tweet": None},
    ],
    "community-tweet": [post("102", "community", community_id_str="9")],
    "note-tweet": [{"noteTweet": {"noteTweetId": "103", "createdAt": "2019-01-02T03:04:05.000Z", "core": {"text": "long", "urls": [{"expandedUrl": "https://n.o/t"}], "hashtags": ["p", {"text": "q"}], "mentions": [{"screenName": "cid"}]}}}],
    "like": [{"like": {"tweetId": "200", "fullText": "liked", "expandedUrl": "https://l.k/1"}}, {"like": {"tWeetId": "201"}}, {"like": {"tweetId": "100", "fullText": "hello"}}],
    "_metadata": {"size": "5", "local_x": "1"},
}
BOB = {"tweets": [post("100", "hello"), post("300", "to liked", in_reply_to_status_id_str="200", in_reply_to_user_id_str="77", in_reply_to_screen_name="zed")], "like": [{"like": {"tweetId": "200", "fullText": "liked"}}]}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    p = tmp_path_factory.mktemp("archives")
    (p / "ann_archive.json").write_text(json.dumps(ANN))
    (p / "bob_archive.json").write_text(json.dumps(BOB))
    (p / "bad_archive.json").write_text('{"tweets": [')
    (p / "list_archive.json").write_text("[1]")
    (p / "notes.json").write_text("{}")
    return str(p)


@pytest.fixture(scope="module")
def found(spark, folder):
    return archives.read_archives(spark, folder)


@pytest.fixture(scope="module")
def tweets(found):
    return archives.source_tweets(found).cache()


def test_reading_and_quarantine(found):
    assert sorted((r["archive_file"], r["corrupt"]) for r in found.collect()) == [("ann_archive.json", False), ("bad_archive.json", True), ("bob_archive.json", False), ("list_archive.json", True)]
    assert {r["archive_file"] for r in archives.quarantined(found).collect()} == {"bad_archive.json", "list_archive.json"}
    assert [tuple(r) for r in archives.accounts(found).where("username is not null").collect()] == [("ann_archive.json", "ann", "1", "Ann")]


def test_flat_rows(tweets):
    assert tweets.schema == schemas.SOURCE_TWEETS or [f.name for f in tweets.schema] == [f.name for f in schemas.SOURCE_TWEETS]
    by = {(r["archive_file"][:3], r["id"], r["tweet_type"]): r for r in tweets.collect()}
    assert len(by) == 10
    a = by[("ann", "100", "tweet")]
    assert (a["user_screen_name"], a["user_id"], a["user_name"], a["favorite_count"], a["retweet_count"]) == ("ann_s", "11", "Ann S", 2, 0)
    assert (a["urls"], a["hashtags"], a["user_mentions"], a["created_at"], a["is_reply"]) == (["https://e.x/a"], ["x"], ["bob"], dt.datetime(2018, 10, 10, 20, 19, 24), False)
    n = by[("ann", "103", "note_tweet")]
    assert (n["urls"], n["hashtags"], n["user_mentions"], n["full_text"]) == (["https://n.o/t"], ["p", "q"], ["cid"], "long")
    k = by[("ann", "200", "like")]
    assert (k["urls"], k["favorited"], k["created_at"], k["user_id"]) == (["https://l.k/1"], True, None, "11")
    assert ("ann", "201", "like") in by and by[("bob", "300", "tweet")]["user_screen_name"] == "bob"
    assert by[("ann", "101", "tweet")]["is_reply"] and by[("ann", "101", "tweet")]["created_at"] is None


def test_consolidation(tweets):
    rows = {r["id"]: r for r in consolidate.consolidated(tweets).collect()}
    assert len(rows) == 7 and rows["100"]["liked_by_users"] == ["11"] and rows["100"]["full_text"].startswith("hello @bob")
    assert (rows["200"]["user_id"], rows["200"]["user_screen_name"], rows["200"]["like_count"]) == ("77", "zed", 2)
    assert rows["101"]["inferred_timestamp"] is not None and rows["201"]["user_id"] is None
    c = {r["id"]: r for r in consolidate.canonical(tweets).collect()}
    assert c[100]["reply_ids"] == [101] and c[200]["author_username"] == "zed" and c[100]["likers"] == ["ann_s"]


def test_conversion_signatures_and_metadata(found):
    assert {r["tweet_type"] for r in archives.converted(found).collect()} == {"tweet", "note", "community"}
    assert archives.format_signatures(found).count() == 2
    assert json.loads(archives.archive_metadata(found).first()["metadata"])["size"] == "5"


def test_lists_logs_and_manifest(spark, tmp_path, found):
    (tmp_path / "names.txt").write_text(" Ann\n\nbob\nANN \n")
    assert sorted(r[0] for r in archives.usernames(spark, str(tmp_path / "names.txt")).collect()) == ["ann", "bob"]
    (tmp_path / "log.csv").write_text("u1,2024-01-01T00:00:00,success\nu1,2024-02-01T00:00:00,success\nu2,2024-01-01T00:00:00,failed\n")
    assert [tuple(r) for r in archives.fetch_log(spark, str(tmp_path / "log.csv")).collect()] == [("u1", dt.datetime(2024, 2, 1))]
    left = archives.not_processed(found, found.where("archive_file like 'a%'"))
    assert left.count() == 3
    cache = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 2, 20))], "url string, fetch_time timestamp")
    assert [r["url"] for r in archives.fresh(cache, F.lit("2024-03-01").cast("timestamp")).collect()] == ["b"]


def test_merge_restores_what_is_missing(spark, tweets):
    ids = consolidate.best_versions(tweets).select("id", "tweet_type", "full_text")
    old, new = ids.where("id > '101'"), ids.where("id < '200'")
    merged = merging.merge_rows(old, new)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, ids.collect()))
    stats = {r["tweet_type"]: (r["old"], r["new"], r["merged"]) for r in merging.merge_stats(old, new, merged).collect()}
    assert stats["like"] == (2, 0, 2)
    m = lambda d: spark.createDataFrame([("f", d)], "archive_file string, metadata map<string,string>")
    got = merging.merge_metadata(m({"size": "1", "local_a": "L", "k": "o"}), m({"size": "2", "local_a": "N"})).first()["metadata"]
    assert got == {"size": "2", "local_a": "L", "k": "o"}


def test_sinks(spark, tweets, tmp_path):
    sinks.by_user(tweets.drop("media"), str(tmp_path / "users"))
    assert {p.name for p in (tmp_path / "users").iterdir() if p.is_dir()} == {"user_safe=ann_s", "user_safe=bob", "user_safe=_"}
    out = str(tmp_path / "t")
    assert sinks.with_backup(tweets, out) is None
    assert sinks.with_backup(tweets.limit(1), out) and spark.read.parquet(out).count() == 1
    assert "archive_file" in sinks.schema_json(tweets)
    sinks.lines(tweets.select(F.col("id").alias("line")), str(tmp_path / "l"), single=True)
    assert spark.read.text(str(tmp_path / "l")).count() == 10


def test_streaming_takes_only_what_is_new(spark, folder, tmp_path):
    import shutil

    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    shutil.copy(f"{folder}/ann_archive.json", src)
    incremental.ingest(spark, str(src), out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 7
    shutil.copy(f"{folder}/bob_archive.json", src)
    incremental.ingest(spark, str(src), out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 10


def test_exports_by_name():
    assert exports.file_name("ann", "chatml") == "ann_chatml.json"
    with pytest.raises(ValueError):
        exports.file_name("ann", "pdf")
