import datetime as dt
import json
import random

import pytest

from threadloom.operators import exports, identity, threads
from threadloom.operators import links as url_ops


def posts(spark, edges):
    return spark.createDataFrame([(i, p, f"u{i % 3}", f"text {i}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)) for i, p in edges], "id long, parent_id long, author string, text string, created_at timestamp")


def slow_closure(edges):
    parent = dict(edges)
    out = set()
    for i in parent:
        x, d, seen = i, 0, set()
        while parent.get(x) in parent and x not in seen:
            seen.add(x)
            x, d = parent[x], d + 1
        if x not in seen and d:
            out |= {(x, i, d), (x, x, 0)}
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_closure_of_forests_with_cycles_and_orphans(spark, seed):
    rng = random.Random(seed)
    edges = []
    for i in range(120):
        r = rng.random()
        edges.append((i, None if r < 0.1 else 1000 + i if r < 0.2 else i if r < 0.23 else max(0, i - rng.randint(1, 6)) if r < 0.95 else rng.randrange(120)))
    got = {(r["root_id"], r["id"], r["depth"]) for r in threads.closure(posts(spark, edges)).collect()}
    assert got == slow_closure(edges)


def test_long_chain_and_pure_cycle(spark):
    chain = [(i, i - 1 if i else None) for i in range(300)]
    got = threads.closure(posts(spark, chain))
    assert got.count() == 300 and got.agg({"depth": "max"}).first()[0] == 299
    assert threads.closure(posts(spark, [(1, 2), (2, 1), (3, 3), (4, 3)])).count() == 0
    assert threads.closure(posts(spark, chain), 2).count() == 3
    assert threads.closure(posts(spark, []).limit(0)).count() == 0


def test_direct_threads_in_time_with_missing_first(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, None, "a", "root", t0), (2, 1, "b", "late", t0 + dt.timedelta(hours=1)), (3, 1, "c", "early", t0 + dt.timedelta(minutes=30)), (4, 1, "d", "undated", None), (5, None, "e", "alone", t0)]
    t = threads.direct_threads(spark.createDataFrame(rows, "id long, parent_id long, author string, text string, created_at timestamp")).collect()
    assert len(t) == 1 and t[0]["length"] == 4 and [r["id"] for r in t[0]["replies"]] == [4, 3, 2]


def test_exports(spark):
    rows = [("1", None, "a", "Hi @x there", dt.datetime(2024, 1, 1)), ("2", "1", "b", "Yo #y", dt.datetime(2024, 1, 2)), ("3", "1", "b", "Third", None)]
    df = spark.createDataFrame(rows, "id string, parent_id string, author string, text string, created_at timestamp")
    roots = threads.direct_threads(df)
    msgs = json.loads(exports.export(roots, "jsonl").first()["line"])["messages"]
    assert [m["role"] for m in msgs] == ["system", "user", "assistant", "user"] and msgs[1]["content"] == "Hi @x there"
    msgs = json.loads(exports.export(roots, "oai").first()["line"])["messages"]
    assert [m["role"] for m in msgs[1:]] == ["user"] * 3 and msgs[1]["content"] == "Hi there" and {m["content"] for m in msgs[2:]} == {"Third", "Yo"}
    chat = json.loads(exports.export(roots, "chatml", None).first()["line"])["messages"]
    assert chat[0]["content"] is None and chat[1]["content"] == "Hi @x there\n[Posted on 2024-01-01 00:00:00]" and chat[2]["content"] == "Third"
    md = exports.export(roots, "markdown").first()["line"]
    assert md.startswith("# Thread started on 2024-01-01 00:00:00\n\n## 2024-01-01 00:00:00\n\nHi @x there\n\nThird")
    one = exports.markdown(df.where("id = '1'")).first()["line"]
    assert one == "# Tweet 1\n\nHi there\n\nPosted on: 2024-01-01 00:00:00\n\n"
    rec = json.loads(exports.jsonl(df.where("id = '3'")).first()["line"])
    assert rec == {"id": "3", "text": "Third", "created_at": None, "media": [], "metadata": None}
    with pytest.raises(ValueError):
        exports.export(roots, "pdf")


def test_identity(spark):
    d = lambda m: dt.datetime(2023, m, 1)
    log = spark.createDataFrame([("1", d(1), 0, "ann", "Ann", None), ("1", d(6), 1, "ann2", None, "pic"), ("2", d(6), 2, "bob", None, None)], "user_id string, ts timestamp, seq long, username string, display_name string, avatar_url string")
    from pyspark.sql import functions as F

    at = lambda m: {r["user_id"]: (r["username"], r["display_name"], r["avatar_url"]) for r in identity.as_of(log, F.lit(d(m))).collect()}
    assert at(3) == {"1": ("ann", "Ann", None)} and at(7) == {"1": ("ann2", "Ann", "pic"), "2": ("bob", "bob", None)}
    asked = spark.createDataFrame([("1", d(3), 1), ("1", d(6), 2), ("2", d(1), 3)], "user_id string, at timestamp, n int")
    got = {r["n"]: r["username"] for r in identity.as_of_each(asked, log).collect()}
    assert got == {1: "ann", 2: "ann2", 3: None}
    assert {r["username"]: r["user_id"] for r in identity.latest(log).collect()} == {"ann": "1", "ann2": "1", "bob": "2"}
    assert identity.merged(log, log.withColumn("user_id", F.lit("9"))).count() == 6
    assert [r["value"] for r in identity.history(log, "username").orderBy("ts", "value").collect()] == ["ann", "ann2", "bob"]
    assert identity.timeline(log).where("seq = 1").first()["display_name"] == "Ann"
    t = identity.with_ids(log.withColumn("user_id", F.lit(None).cast("string"))).first()
    assert t["user_id"].startswith("TEMP_")


def test_url_table(spark):
    df = spark.createDataFrame([("ann", "1", None, "see https://a.b/x?y=1#z https://t.co/q", ["https://a.b/x?y=1#z", "https://www.youtube.com/v", None]), ("ann", "2", None, "none", None)], "username string, tweet_id string, tweet_created_at timestamp, full_text string, entity_urls array<string>")
    t = url_ops.url_table(df)
    assert len(t.columns) == 15 and {r["domain"] for r in t.where("tweet_id = '1'").collect()} == {"a.b", "t.co", "youtube.com"}
    pages = spark.createDataFrame([("https://t.co/q", "T", 200), ("https://t.co/q", "T", 200)], "url string, title string, status_code int")
    joined = url_ops.with_content(t, pages)
    assert joined.count() == t.count() and joined.where("title = 'T'").count() == 1

    def fetch(frames):
        for f in frames:
            yield f.assign(resolved="https://full/" + f["url"].str[-1])

    r = {x["url"]: (x["is_resolved"], x["resolved"]) for x in url_ops.resolved(t, fetch).collect()}
    assert r["https://t.co/q"] == (True, "https://full/q") and r["https://a.b/x?y=1#z"] == (False, None)
    assert {x["url"]: x["category"] for x in url_ops.categories(t).collect()}["https://t.co/q"] == "unresolved"
    assert [tuple(x) for x in url_ops.value_counts(t, "protocol").collect()] == [("https", 3)]
    empty = url_ops.url_table(df.limit(0))
    assert empty.count() == 0 and len(empty.columns) == 15
