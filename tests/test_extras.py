import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.config import Settings, after_failure
from threadloom.operators import links as url_ops
from threadloom.operators import profile, similarity
from threadloom.sources import archives
from threadloom.streaming import incremental


def test_settings_round_trip(tmp_path):
    p = tmp_path / "s.json"
    assert Settings.load(p) == Settings()
    Settings(max_retries=5, blacklist=["a.b"]).save(p)
    assert Settings.load(p) == Settings(max_retries=5, blacklist=["a.b"])
    p.write_text('{"unknown": 1, "cache_days": 7}')
    assert Settings.load(p).cache_days == 7


def test_failure_policy():
    failures, black = {}, set()
    assert after_failure("a", 500, failures, black) == "retry" and after_failure("a", None, failures, black) == "retry"
    assert after_failure("a", 500, failures, black) == "blacklist" and after_failure("b", 404, failures, black) == "blacklist"
    assert black == {"a", "b"} and after_failure("a", 200, failures, black) == "blacklist"


def test_similarity(spark):
    same, other = "the quick brown fox jumps over the lazy dog " * 20, "0123456789 lorem ipsum dolor sit amet consectetur " * 20
    texts = spark.createDataFrame([("a", same), ("b", same), ("c", other), ("d", None)], "user string, text string")
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("d", "d")], "a string, b string")
    out = {(r["a"], r["b"]): r["distance"] for r in similarity.similar_users(texts, pairs, 1.0).collect()}
    assert 0 <= out[("a", "b")] < 0.3 < out[("a", "c")] <= 1 and out[("d", "d")] == 0
    edges = spark.createDataFrame([("a", "b", "reply"), ("a", "b", "mention"), ("a", "a", "quote"), ("b", "a", "like")], "source string, target string, kind string")
    assert [tuple(r) for r in similarity.interaction_scores(edges).collect()] == [("a", "b", 1.5)]


def test_kinds(spark):
    t = spark.createDataFrame([], schemas.SOURCE_TWEETS)
    assert archives.rows_of_kind(t, "note").count() == 0
    with pytest.raises(ValueError):
        archives.rows_of_kind(t, "video")


def test_entities_and_profiles(spark):
    import json

    doc = {"profile": [{"profile": {"description": {"bio": "b"}, "avatarMediaUrl": "u"}}], "tweets": [{"tweet": {"id_str": "1", "entities": {"urls": [{"url": "s", "indices": ["1", "x"]}], "user_mentions": [{"screen_name": "n", "id": "12"}]}, "extended_entities": {"media": [{"type": "photo", "media_url": "m", "sizes": {"thumb": {"w": "1", "h": "2", "resize": "crop"}}}]}}}]}
    df = archives.parse_archives(spark.createDataFrame([("a_archive.json", json.dumps(doc))], "archive_file string, raw string"))
    assert tuple(archives.profiles(df).first())[1:] == ("b", "", "", "u", "")
    p = df.select(F.col("archive.tweets")[0]["tweet"].alias("t"))
    e = p.select(archives.typed_entities(F.col("t.entities")).alias("e"), archives.typed_media(F.col("t.extended_entities.media")).alias("m")).first()
    assert e["e"]["urls"][0]["expanded_url"] == "s" and e["e"]["urls"][0]["indices"] == [1, None] and e["e"]["user_mentions"][0]["id"] == 12
    assert e["m"][0]["sizes"]["thumb"]["h"] == 2
    assert {r["section"] for r in archives.structure(df).collect()} == set(archives.SECTIONS)
    assert archives.sampled(df, 5).count() == 1


def test_fetching_is_once_a_url(spark):
    urls = spark.createDataFrame([("https://a.b/1",), ("https://a.b/1",), ("https://a.b/2",), ("relative",)], "url string")
    done = spark.createDataFrame([("https://a.b/2",)], "url string")

    def fetch(frames):
        for f in frames:
            yield f[["url"]].assign(title="T", status_code=200)

    got = url_ops.fetch_pages(urls, done, fetch, "url string, title string, status_code int")
    assert [r["url"] for r in got.collect()] == ["https://a.b/1"]
    rec = url_ops.fetch_records(got).first()
    assert len(rec["key"]) == 64 and '"status_code":200' in rec["record"]


def test_array_lengths_of_arrays(spark):
    df = spark.createDataFrame([("a", ["x", "y"]), ("a", []), ("b", None)], "k string, v array<string>")
    assert {r["k"]: (r["entries"], r["with_entries"], r["most"]) for r in profile.array_lengths(df, "v", "k").collect()} == {"a": (2, 1, 2), "b": (0, 0, 0)}


def test_streams_of_events(spark, tmp_path):
    rows = [(1, "u1", "2024-01-01 00:00:00", "view"), (1, "u1", "2024-01-01 00:10:00", "view"), (1, "u2", "2024-01-01 02:00:00", "click")]
    spark.createDataFrame(rows, "user_id int, url string, ts string, event_type string").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "e"))
    stream = lambda: spark.readStream.schema("user_id int, url string, ts timestamp, event_type string").parquet(str(tmp_path / "e"))
    for i, (df, mode, n) in enumerate([(incremental.first_seen_urls(stream()), "append", 2), (incremental.activity(stream()), "complete", 2), (incremental.sessions(stream()), "complete", 2)]):
        q = df.writeStream.format("memory").queryName(f"m{i}").outputMode(mode).option("checkpointLocation", str(tmp_path / f"c{i}")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(f"m{i}").count() == n


def test_reports_and_replacement_with_backup(spark, tmp_path):
    from threadloom.operators import consolidate, profile
    from threadloom.plans import carriers
    from threadloom.sources import sinks

    tweets = carriers.source(spark, "/root/testdata/sf0.001")
    seen = profile.verification(tweets, consolidate.consolidated(tweets)) | profile.inspection(tweets)
    assert all(df.count() >= 1 for k, df in seen.items() if k not in ("duplicate_rows", "hot_threads"))
    assert all(r["agree"] for r in seen["likers"].collect()) and seen["thread_sizes"].first()["threads"] > 0
    path = str(tmp_path / "t")
    assert sinks.with_backup(spark.range(3), path) is None
    old = sinks.with_backup(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and spark.read.parquet(old).count() == 3
    sinks.by_user(spark.createDataFrame([(i, "hot" if i % 3 else f"u{i}") for i in range(90)], "id long, user_screen_name string"), path + "u", rows_per_file=10)
    out = spark.read.parquet(path + "u")
    assert out.count() == 90 and out.where("user_safe = 'hot'").count() == 60


def test_shared_folder_is_asked_for_on_a_cluster(spark):
    from types import SimpleNamespace

    import pytest

    from threadloom.operators import durable

    unset = SimpleNamespace(isDefined=lambda: False)
    for master in ("yarn", "spark://h:1", "local-cluster[2,1,1024]", "k8s://x"):
        fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset))))
        with pytest.raises(ValueError, match="checkpoint"):
            durable.shared_dir(fake)
