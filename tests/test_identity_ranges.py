"""Carrying by ranges against a plain scan, with a user that has most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import identity

DAY = dt.datetime(2023, 1, 1)
LOG = "user_id string, ts timestamp, seq long, username string, display_name string, avatar_url string"


@pytest.fixture(scope="module")
def log():
    rng = random.Random(4)
    some = lambda v: v if rng.random() < 0.3 else None
    rows = []
    for seq in range(6000):
        user = rng.choice(["hot"] * 8 + ["a", "b", None, "c"])
        rows.append((user, DAY + dt.timedelta(minutes=rng.choice([7, 7, rng.randint(0, 5000)])), seq, some(f"n{seq}"), some(f"d{seq}"), some(f"v{seq}") if seq % 500 == 0 else None))
    return rows


def scan(rows, key):
    """Last known values after each row, in order."""
    known = {}
    for r in sorted(rows, key=key):
        now = known.setdefault(r[0], [None] * 3)
        for i, v in enumerate(r[3:6]):
            now[i] = v if v is not None else now[i]
        yield r, tuple(now)


def test_timeline_of_a_hot_user(spark, log):
    want = sorted(repr((r[0], r[1], r[2], *now)) for r, now in scan(log, lambda r: (r[1], r[2])))
    got = identity.timeline(spark.createDataFrame(log, LOG).repartition(5))
    assert got.columns == ["user_id", "ts", "seq", *identity.FIELDS]
    assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_every_event_of_a_hot_user(spark, log):
    rng = random.Random(5)
    asked = [(rng.choice(["hot", "hot", "a", "none", None]), DAY + dt.timedelta(minutes=rng.choice([7, 6, rng.randint(0, 6000)])), i) for i in range(3000)]
    events = spark.createDataFrame(asked, "user_id string, at timestamp, n long")
    both = [(*r, 0) for r in log] + [(u, t, 1 << 40, None, None, None, n) for u, t, n in asked]
    want = sorted(repr((r[0], r[1], r[6], *now)) for r, now in scan(both, lambda r: (r[1], r[2])) if r[2] == 1 << 40)
    got = identity.as_of_each(events, spark.createDataFrame(log, LOG))
    assert sorted(repr(tuple(r)) for r in got.select("user_id", "at", "n", *identity.FIELDS).collect()) == want


def test_a_user_is_spread_over_tasks(spark):
    """Even one whose rows share a moment; the first value reaches the last row."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        one = spark.range(200_000).select(F.lit("u").alias("user_id"), F.lit(DAY).alias("ts"), F.col("id").alias("seq"), *[F.when(F.col("id") == 0, F.lit(f)).alias(f) for f in identity.FIELDS])
        got = identity.timeline(one)
        assert got.where("username = 'username' and avatar_url = 'avatar_url'").count() == 200_000
        events = one.select("user_id", F.col("ts").alias("at"), F.col("seq").alias("n"))
        assert identity.as_of_each(events, one.limit(1)).where("display_name is not null").count() == 200_000
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(user_id" in plan and "__part" in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_names_that_clash_and_no_rows(spark):
    rows = spark.createDataFrame([("u", 1, "x", None), ("u", 2, None, 5)], "__part string, __at int, __row string, __known int")
    got = identity.carried(rows, "__part", [F.asc("__at")], ["__row", "__known"])
    assert sorted(map(tuple, got.collect())) == [("u", 1, "x", None), ("u", 2, "x", 5)]
    assert identity.carried(rows.limit(0), "__part", [F.asc("__at")], ["__row"]).count() == 0
