"""User identities over time: a change log and lookups in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import scalar
from threadloom.operators.durable import written

FIELDS = ("username", "display_name", "avatar_url")


def with_ids(log: DataFrame) -> DataFrame:
    """Rows without ``user_id`` get a stand-in from the name; display falls back to it."""
    return log.withColumns({"user_id": F.coalesce("user_id", scalar.temporary_id("username")), "display_name": F.coalesce("display_name", "username")})


def history(log: DataFrame, field: str) -> DataFrame:
    """``user_id, ts, value`` of every change of one field."""
    return log.where(F.col(field).isNotNull()).select("user_id", "ts", F.col(field).alias("value"))


def carried(stream: DataFrame, by: str, order: Sequence[Column], fields: Sequence[str]) -> DataFrame:
    """``stream`` with each field's last value so far that is not null, per ``by``.

    A scan of two levels. Rows are dealt by ranges of key and order, so that a
    key of any number of rows, at however few moments, is spread over tasks. Each
    range carries its own values; what a range ends with is carried on over the
    later ranges of the same key and fills what those have not set yet. Only keys
    at a border of ranges are in several, so that table has two rows a range at
    most and is broadcast. A null key is a key.
    """
    n = int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row, at, part, known = (_unused(x, stream.columns) for x in ("row", "at", "part", "known"))
    keys = [F.col(by).asc(), *order, F.col(row).asc()]
    dealt = stream.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    rows = written(dealt.withColumn(at, F.monotonically_increasing_id()).withColumn(part, F.shiftright(at, 33)).drop(row), "carried")
    ends = rows.groupBy(by, part).agg(*[F.max_by(f, F.when(F.col(f).isNotNull(), F.col(at))).alias(f) for f in fields])
    several = ends.withColumn(row, F.count("*").over(Window.partitionBy(by))).where(F.col(row) > 1)
    before = Window.partitionBy(by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    first = several.select(F.col(by).alias(f"{by}{known}"), F.col(part).alias(known), *[F.last(f, ignorenulls=True).over(before).alias(f"{f}{known}") for f in fields])
    own = Window.partitionBy(by, part).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumns({f: F.last(f, ignorenulls=True).over(own) for f in fields})
    filled = inside.join(F.broadcast(written(first, "carried-on")), F.col(by).eqNullSafe(F.col(f"{by}{known}")) & (F.col(part) == F.col(known)), "left")
    return filled.select(*[F.coalesce(f"`{c}`", f"`{c}{known}`").alias(c) if c in fields else F.col(f"`{c}`") for c in stream.columns])


def _unused(name: str, taken: list[str]) -> str:
    name = f"__{name}"
    while any(c.lower().startswith(name) or c.lower().endswith(name) for c in taken):
        name += "_"
    return name


def timeline(log: DataFrame) -> DataFrame:
    """The log with what is known at each change: the last value of each field."""
    return carried(log, "user_id", [F.asc("ts"), F.asc("seq")], FIELDS)


def as_of(log: DataFrame, at: Column) -> DataFrame:
    """Each user's identity at a moment; users without a name by then are left out.

    Maxima by time with map-side combining: no window, no sort.
    """
    past = log.where(F.col("ts") <= at)
    latest = lambda f: F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.struct("ts", "seq")))
    known = past.groupBy("user_id").agg(*[latest(f).alias(f) for f in FIELDS], F.max("ts").alias("changed_at"))
    return known.where("username is not null").withColumn("display_name", F.coalesce("display_name", "username"))


def as_of_each(events: DataFrame, log: DataFrame) -> DataFrame:
    """As-of join: every event ``(user_id, at, ...)`` with the identity then.

    Events and changes are one stream a user, and the last value before an
    event is carried to it, range by range; no range join.
    """
    extra = [c for c in events.columns if c not in ("user_id", "at")]
    null = lambda t: F.lit(None).cast(t)
    changes = log.select("user_id", F.col("ts").alias("at"), F.lit(0).alias("is_event"), "seq", *FIELDS, *[null(events.schema[c].dataType).alias(c) for c in extra])
    asked = events.select("user_id", "at", F.lit(1).alias("is_event"), null("long").alias("seq"), *[null("string").alias(f) for f in FIELDS], *extra)
    out = carried(changes.unionByName(asked), "user_id", [F.asc("at"), F.asc("is_event"), F.col("seq").asc_nulls_last()], FIELDS)
    return out.where("is_event = 1").select("user_id", "at", *extra, *FIELDS)


def latest(log: DataFrame) -> DataFrame:
    """Username to id: the last mapping of each name wins."""
    return log.where("username is not null").groupBy("username").agg(F.max_by("user_id", F.struct("ts", "seq")).alias("user_id"))


def merged(known: DataFrame, found: DataFrame) -> DataFrame:
    """``known`` and the users of ``found`` that it lacks."""
    return known.unionByName(found.join(known.select("user_id").distinct(), "user_id", "left_anti").select(*known.columns))
