"""Similarity of users: what they write and whom they answer (an extra)."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from threadloom.operators.durable import written

#: Minima of a user's sketch, and how many of them a band has.
MINIMA, BAND = 64, 2
#: Users of a bucket that meet each other; beyond that the next band must be common, too.
CROWD = 64
#: Bytes of text in a piece, parts of the whole work at least as large as which parts are, tasks they are spread over at most.
CHUNK, PARTS, MOST_TASKS = 262_144, 32, 2_000
#: Weights of the ways of interacting. Fixed values.
WEIGHTS = {"mention": 0.7, "reply": 0.8, "quote": 0.6}


@F.pandas_udf(T.DoubleType())
def compression_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Normalized compression distance of two texts, within 0 and 1."""

    def one(x, y):
        x, y = (x or "").encode(), (y or "").encode()
        if not x and not y:
            return 0.0
        cx, cy, cxy = (len(zlib.compress(t, 9)) for t in (x, y, x + y))
        return min(1.0, max(0.0, (cxy - min(cx, cy)) / max(cx, cy)))

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)])


def interaction_scores(edges: DataFrame) -> DataFrame:
    """``source, target, kind`` to one weighted score a pair."""
    weight = None
    for kind, w in WEIGHTS.items():
        weight = F.when(F.col("kind") == kind, w) if weight is None else weight.when(F.col("kind") == kind, w)
    return edges.withColumn("w", weight).where("w is not null and source <> target").groupBy("source", "target").agg(F.round(F.sum("w"), 6).alias("score"))


def similar_users(texts: DataFrame, pairs: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Distance of the texts of given pairs of users, up to a threshold.

    ``texts`` has ``user, text``; ``pairs`` has ``a, b``: those who interact,
    not all of them with all.
    """
    ta = texts.select(F.col("user").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("user").alias("b"), F.col("text").alias("tb"))
    out = pairs.select("a", "b").distinct().join(ta, "a").join(tb, "b").select("a", "b", compression_distance("ta", "tb").alias("distance"))
    return out.where(F.col("distance") <= threshold)


def active_users(posts: DataFrame, likes: DataFrame | None = None, least_posts: int = 1, least_likes: int = 0) -> DataFrame:
    """``user`` of those with so many posts (``user, text``) and likes (``user``)."""
    many = posts.where("user is not null").groupBy("user").count().where(F.col("count") >= least_posts).select("user")
    if least_likes and likes is not None:
        many = many.join(likes.groupBy("user").count().where(F.col("count") >= least_likes).select("user"), "user", "left_semi")
    return many


def sketches(posts: DataFrame) -> DataFrame:
    """``user, bands``: minima of hashed words, in bands; aggregates with map-side combining."""
    words = F.explode(F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")))
    said = posts.select("user", words.alias("word"))
    least = said.groupBy("user").agg(*[F.min(F.xxhash64(F.col("word"), F.lit(i))).alias(f"m{i}") for i in range(MINIMA)])
    bands = F.array(*[F.xxhash64(*[F.col(f"m{i}") for i in range(b, b + BAND)]) for b in range(0, MINIMA, BAND)])
    return least.select("user", bands.alias("bands"))


def candidates(posts: DataFrame, edges: DataFrame | None = None, crowd: int = CROWD) -> DataFrame:
    """``a, b`` (a < b): users that share a band, or interact: a guess, which misses similar users.

    For a first look only. ``user_similarity`` does not use it, but compares all.
    Users of equal sketches are a class, and only its first user meets others.
    The users of a bucket meet in pairs up to ``crowd`` of them; the users of a
    fuller one are dealt again by the band after, round by round, so no bucket
    makes more pairs than that. All bands round, users would be one class.
    """
    own = written(sketches(posts), "sketches")
    classes = written(own.groupBy("bands").agg(F.min("user").alias("first")), "sketch-classes")
    within = own.join(classes, "bands").where("user != first").select(F.col("first").alias("a"), F.col("user").alias("b"))
    n = MINIMA // BAND
    open_ = classes.select("first", "bands", F.posexplode("bands").alias("at", "key"))
    rounds = [within]
    for step in range(1, n + 1):
        sizes = written(open_.groupBy("at", "key").agg(F.count("*").alias("size")).where("size > 1"), "sketch-sizes")
        held = written(open_.join(sizes, ["at", "key"]), "sketch-buckets")
        few = held.where(F.col("size") <= crowd).select("at", "key", "first")
        pairs = few.withColumnRenamed("first", "a").join(few.withColumnRenamed("first", "b"), ["at", "key"]).where("a < b").select("a", "b")
        rounds.append(pairs)
        full = held.where(F.col("size") > crowd)
        if full.isEmpty():
            break
        open_ = full.select("first", "bands", "at", F.xxhash64("key", F.element_at("bands", (F.pmod(F.col("at") + step, F.lit(n)) + 1).cast("int"))).alias("key"))
    if edges is not None:
        rounds.append(edges.where("source != target").select(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b")))
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out.distinct()


def chunks(posts: DataFrame) -> DataFrame:
    """``user, id, n, size, packed``: all that a user wrote, cut into packed pieces, in the order of ``id, n``.

    Posts (``user, id, text``) follow each other by ``id, text``, each after a
    blank, so the first byte of a user's first piece is none of theirs.
    """
    each = posts.select("user", "id", F.coalesce("text", F.lit("")).alias("text"))
    n = int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # rows of equal user and id stay together, so the pieces of two partitions never interleave
    ordered = each.repartitionByRange(n, "user", "id").sortWithinPartitions("user", "id", "text")
    id_type = posts.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(T.StructType([T.StructField("user", T.StringType()), T.StructField("id", id_type)]))
        schema = schema.append(pa.field("n", pa.int64())).append(pa.field("size", pa.int64())).append(pa.field("packed", pa.binary()))
        user, first, n, held = None, None, 0, bytearray()
        done: list[tuple] = []

        def cut(size):
            nonlocal n
            done.append((user, first, n, size, pa.compress(bytes(held[:size]), "zstd", asbytes=True)))
            del held[:size]
            n += 1

        def batch_of():
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
            done.clear()
            return out

        for batch in batches:
            for u, i, text in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                if u != user:
                    if held:
                        cut(len(held))
                    user, n = u, 0
                if not held:
                    first = i
                held += b" " + text.encode("utf-8", "surrogatepass")
                while len(held) >= CHUNK:
                    cut(CHUNK)
                    first = i
                if len(done) >= 64:
                    yield batch_of()
        if held:
            cut(len(held))
        if done:
            yield batch_of()

    return ordered.mapInArrow(run, T.StructType([T.StructField("user", T.StringType()), T.StructField("id", id_type)]).add("n", "long").add("size", "long").add("packed", "binary"))


def ncd(x: Column, y: Column, xy: Column) -> Column:
    """Compression distance by the sizes of two texts and of both in a row, within 0 and 1."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (xy - F.least(x, y)) / F.greatest(x, y)))


def whole_texts(pieces: DataFrame) -> DataFrame:
    """``user, own, sure, digest``: size of a user's packed text, what of it is out before the text ends, and a SHA-256.

    Whatever follows the text, at least ``sure`` bytes come out.
    """
    # as below: few users are spread over many tasks
    n = max(int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(8 * pieces.select("user").distinct().count(), MOST_TASKS))
    stream = pieces.repartition(n, "user").sortWithinPartitions("user", F.asc_nulls_first("id"), "n").select("user", "size", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user = packer = digest = None
        sure = 0
        done: list[tuple] = []

        def end():
            if user is not None:
                done.append((user, sure + len(packer.flush()), sure, digest.digest()))

        def batch_of():
            types = pa.string(), pa.int64(), pa.int64(), pa.binary()
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=["user", "own", "sure", "digest"])
            done.clear()
            return out

        for batch in batches:
            for u, raw, packed in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                data = pa.decompress(packed, raw, "zstd", asbytes=True)
                if u != user:
                    end()
                    user, packer, digest, sure = u, zlib.compressobj(9), hashlib.sha256(), 0
                    data = data[1:]
                sure += len(packer.compress(data))
                digest.update(data)
            if done:
                yield batch_of()
        end()
        if done:
            yield batch_of()

    return stream.mapInArrow(run, "user string, own long, sure long, digest binary")


def possible_pairs(classes: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: first users of all classes of equal texts (``first, last, own, sure``) that may be within the threshold.

    ``a`` goes first: some user of its class is before some of the other, or of
    the same class. Left out is only what what is surely packed of ``a`` alone
    puts beyond the threshold, so nothing similar is.
    """
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a = classes.select(F.col("first").alias("a"), F.col("own").alias("x"), "sure").repartition(n, "a")
    b = classes.select(F.col("first").alias("b"), "last", F.col("own").alias("y"))
    return a.join(F.broadcast(b), (F.col("a") < F.col("last")) & (ncd(F.col("x"), F.col("y"), F.col("sure")) <= threshold)).select("a", "b")


def dealt(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """``a, part, b``: the pairs of an ``a`` in parts, and each user that is no ``a`` with a null ``b``.

    A part compresses the text of ``a`` once, then each ``b`` behind it. It has
    about as much text of others as ``a`` has, or more where the whole work is
    far larger, so that little is done twice and no part is much of the whole.
    """
    of = pairs.join(sizes.withColumnRenamed("user", "b"), "b").select("a", "b", F.col("size").alias("of_b"))
    sums = of.groupBy("a").agg(F.sum("of_b").alias("of_all")).join(sizes.withColumnRenamed("user", "a"), "a")
    whole = sums.agg((F.sum("of_all") / PARTS).alias("least"))
    parts = sums.crossJoin(F.broadcast(whole)).select("a", F.ceil(F.col("of_all") / F.greatest("size", "least", F.lit(1))).alias("parts"))
    met = of.join(parts, "a").select("a", F.pmod(F.xxhash64("a", "b"), F.col("parts")).alias("part"), "b")
    alone = pairs.select(F.col("b").alias("a")).distinct().join(sums, "a", "left_anti")
    return met.unionByName(alone.select("a", F.lit(0).cast("long").alias("part"), F.lit(None).cast("string").alias("b")))


def distances(posts: DataFrame, pairs: DataFrame, pieces: DataFrame | None = None) -> DataFrame:
    """``a, b, distance``: compression distance of all that two users wrote; ``pieces`` are their ``chunks``, if cut before.

    A compressor that has read all of ``a`` is copied for each ``b`` that meets
    it, so a text of ``a`` is compressed once a part, not once a pair. Texts
    stream through in pieces; a task holds no user's text.
    """
    pieces = written(chunks(posts), "user-chunks") if pieces is None else pieces
    sizes = pieces.groupBy("user").agg(F.sum("size").alias("size"))
    plan = written(dealt(pairs, sizes), "user-parts")
    keys = plan.select("a", "part").distinct()
    first = keys.join(pieces.withColumnRenamed("user", "a"), "a").select("a", "part", F.lit(None).cast("string").alias("b"), "id", "n", "size", "packed")
    then = plan.where("b is not null").join(pieces.withColumnRenamed("user", "b"), "b").select("a", "part", "b", "id", "n", "size", "packed")
    # few parts are spread over many tasks, so that two large ones seldom share one
    n = max(int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(8 * keys.count(), MOST_TASKS))
    stream = first.unionByName(then).repartition(n, "a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"), F.asc_nulls_first("id"), "n").select("a", "part", "b", "size", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = other = base = now = None
        size = 0
        done: list[tuple] = []

        def end():
            """The size of what was read last: of ``a``, or of ``a`` and ``b``."""
            if key is not None:
                done.append((key[0], other, size + len(now.copy().flush())))

        for batch in batches:
            for a, part, b, raw, packed in zip(*[batch.column(k).to_pylist() for k in range(5)], strict=True):
                at, data = (a, part), pa.decompress(packed, raw, "zstd", asbytes=True)
                if at != key:
                    end()
                    key, other, now, size = at, None, zlib.compressobj(9), 0
                    data = data[1:]
                elif b != other:
                    end()
                    if other is None:
                        base = now, size
                    other, now, size = b, base[0].copy(), base[1]
                size += len(now.compress(data))
            if done:
                yield sizes_of(done)
        end()
        if done:
            yield sizes_of(done)

    def sizes_of(done):
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.string(), pa.int64()), strict=True)], names=["a", "b", "size"])
        done.clear()
        return out

    packed_sizes = written(stream.mapInArrow(run, "a string, b string, size long"), "user-sizes")
    own = packed_sizes.where("b is null").groupBy("a").agg(F.min("size").alias("own"))
    both = packed_sizes.where("b is not null").join(own.withColumnRenamed("own", "x"), "a").join(own.select(F.col("a").alias("b"), F.col("own").alias("y")), "b")
    return both.select("a", "b", ncd(F.col("x"), F.col("y"), F.col("size")).alias("distance"))


def user_similarity(posts: DataFrame, edges: DataFrame | None = None, likes: DataFrame | None = None, least_posts: int = 2, least_likes: int = 0, threshold: float = 0.7) -> DataFrame:
    """``user, other, distance, similarity`` of similar users, both ways; a sparse matrix as a table.

    All active users are compared with all, also those without a word in common,
    so ``edges`` add none. Users of equal texts are compared once, by their first.
    """
    active = written(active_users(posts, likes, least_posts, least_likes), "active-users")
    own = posts.join(active, "user", "left_semi")
    pieces = written(chunks(own), "user-chunks")
    texts = written(whole_texts(pieces), "user-texts")
    classes = written(texts.groupBy("digest").agg(F.min("user").alias("first"), F.max("user").alias("last"), F.min_by("own", "user").alias("own"), F.min_by("sure", "user").alias("sure")), "text-classes")
    found = written(distances(own, possible_pairs(classes, threshold), pieces).where(F.col("distance") <= threshold), "similar-texts")
    members = texts.join(classes, "digest").select("user", "first")
    left, right = members.toDF("user", "a"), members.toDF("other", "b")
    near = found.join(left, "a").join(right, "b").where("user < other").select("user", "other", "distance")
    both = near.unionByName(near.select(F.col("user").alias("other"), F.col("other").alias("user"), "distance"))
    return both.withColumn("similarity", 1 - F.col("distance"))
