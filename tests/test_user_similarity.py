"""Candidates by sketches and distances by streams against all pairs."""

import random
import zlib

import pytest

from threadloom.operators import similarity

SCHEMA = "user string, id long, text string"


def ncd(x, y):
    cx, cy, cxy = (len(zlib.compress(t.encode(), 9)) for t in (x, y, x + " " + y))
    return min(1.0, max(0.0, (cxy - min(cx, cy)) / max(cx, cy)))


@pytest.fixture(scope="module")
def posts():
    rng = random.Random(2)
    topics = [["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(60)] for _ in range(12)]
    rows = []
    for u in range(60):
        topic = topics[u % 12]
        rows += [(f"u{u:02}", i, " ".join(rng.choice(topic) for _ in range(12))) for i in range(14)]
    return rows + [("once", 1, "a single post"), ("null", 1, None), ("null", 2, ""), (None, 3, "nobody's")]


def test_recall_against_all_pairs(spark, posts):
    whole = {}
    for u, _, t in sorted((r for r in posts if r[0] and r[0] != "once"), key=lambda r: r[:2]):
        whole[u] = t or "" if u not in whole else whole[u] + " " + (t or "")
    want = {(a, b): ncd(whole[a], whole[b]) for a in whole for b in whole if a < b}
    near = {p for p, d in want.items() if d <= 0.7}
    got = {(r["user"], r["other"]): r["distance"] for r in similarity.user_similarity(spark.createDataFrame(posts, SCHEMA).repartition(5)).collect()}
    assert all(got[b, a] == d for (a, b), d in got.items())  # both ways
    assert all(abs(want[p] - d) < 1e-12 for p, d in got.items() if p in want)
    found = {p for p in got if p in want}
    assert found <= near and len(found) >= 0.9 * len(near) > 50
    assert similarity.candidates(spark.createDataFrame(posts, SCHEMA)).count() < 0.5 * len(want)  # not all with all


def test_crowds_and_copies_make_no_square(spark):
    rng = random.Random(3)
    common = [f"w{i}" for i in range(50)]
    rows = [(f"c{u:03}", 1, " ".join(common)) for u in range(300)]  # equal sketches
    rows += [(f"d{u:03}", 1, " ".join([*rng.sample(common, 49), f"own{u}"])) for u in range(300)]  # alike
    found = similarity.candidates(spark.createDataFrame(rows, SCHEMA), crowd=16)
    n = found.count()
    assert n < 600 * 32 * 16 / 2 and found.where("a like 'c%' and b like 'c%'").count() == 299
    assert found.where("a like 'd%' or b like 'd%'").count() > 300


def test_thresholds_and_edges(spark, posts):
    df = spark.createDataFrame(posts, SCHEMA)
    edges = spark.createDataFrame([("u00", "u01", "reply"), ("u05", "u05", "quote"), ("once", "u00", "mention")], "source string, target string, kind string")
    pairs = {tuple(r) for r in similarity.candidates(df, edges).collect()}
    assert ("u00", "u01") in pairs and ("u05", "u05") not in pairs
    likes = spark.createDataFrame([("u00",), ("u12",), ("u12",), ("once",)], "user string")
    assert {r["user"] for r in similarity.active_users(df, likes, 2, 1).collect()} == {"u00", "u12"}
    got = similarity.user_similarity(df, edges, likes, least_posts=2, least_likes=1, threshold=1.0)
    assert {(r["user"], r["other"]) for r in got.collect()} == {("u00", "u12"), ("u12", "u00")}
    assert similarity.user_similarity(df.limit(0)).count() == 0
