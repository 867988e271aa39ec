"""One document of each group of similar texts (the pipeline's stage).

Two texts are similar where their sets of five-word shingles (lower-case ASCII
words, 64-bit digests) have a Jaccard similarity of 0.8 or more. Most are found by
operator 7's method: each set has a SimHash, all fingerprints are compared in
tiles, and pairs within its radius are checked by their whole sets. Fingerprints
alone would miss some (at 0.8 they are 9.7 bits apart in the mean, give or take
2.9), so what the tiles leave apart is completed exactly: of two sets that similar,
in any one order of all shingles, the first fifth of both has a shingle in common
(prefix filter), and so many that the rest cannot make up for fewer. Pairs that
pass are compared by their whole sets, too. So all such pairs are found, none by
chance.

The first order is by digest, with shingles that are frequent in a sample of texts
last (a fixed share of them, so that it tells as much of a larger corpus); what it leaves open is compared in the order of counts over all the sets in
question, so that common passages do not make pairs. Orders bear on the work
alone: the pairs found are the same in any.

Defined results: a text of fewer words is one shingle; null and empty texts have
the empty set and are copies of each other; a group is the closure of its pairs;
the row with the smallest ``doc_id`` stays for it (of several with that id the
one whose text has the smallest digest; a row without ``doc_id`` only where no
row of the group has one); of rows with equal id and text one stays, the last by
its other columns as JSON. Texts of any length are read whole; other columns, maps
too, whatever their names, stay as they are; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import simhash
from threadloom.llm.common import BROADCAST_ROWS, text_mark, without_rows, written
from threadloom.llm.simhash import SEED, components

SHINGLE = 5
#: Bits by which fingerprints may differ that are checked first.
RADIUS = 3
#: Share of the texts whose shingles are counted for the order, and shingles put last.
ORDER_SHARE, ORDER_SHINGLES = 1 / 8, 200_000
#: Sets that the holders of one shingle may meet first, by the shingle's digest.
HUBS = 4
#: Open sets of a shingle that meet each other at once.
CROWD = 32
#: Shingles of a set that goes whole to where its crowd meets; pairs of larger ones are checked after it.
CARRIED = 1_000


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct shingle digests, ascending."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    line = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64).view(np.int64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[: len(words) - shingle]]).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    return np.unique(np.frombuffer(b"".join([digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)]), ">u8").astype(np.uint64).view(np.int64))


def _prefix_size(n: int) -> int:
    """Any set at 0.8 or more shares one of so many first shingles."""
    return n - (4 * n + 4) // 5 + 1 if n else 0


def _ordered_prefix(found: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    size = _prefix_size(len(found))
    if len(common) and len(found):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        late = common[at] == found
        if late.any():
            found = np.concatenate([found[~late], found[late][np.argsort(rank[at[late]])]])
    return found[:size]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)])))


def _map_sets(df: DataFrame, common: tuple[np.ndarray, np.ndarray] | None, schema: str) -> DataFrame:
    """``text`` replaced by ``high, low``, the digest of its set, ``fp``, its fingerprint, ``n`` and the set's prefix, or by its whole set."""
    keys = [c for c in df.columns if c != "text"]
    held = None if common is None else df.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t) for t in part.column("text").to_pylist()]
                cols = {c: part.column(c) for c in keys}
                if held is not None:
                    marks = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes(), SEED) for s in sets), ">i8").astype(np.int64).reshape(-1, 2)
                    cols["high"], cols["low"] = pa.array(marks[:, 0]), pa.array(marks[:, 1])
                    cols["fp"] = pa.array(np.array([simhash.majority(s.tobytes()) for s in sets], np.uint64).view(np.int64))
                    cols["n"] = pa.array([len(s) for s in sets], pa.int32())
                    sets = [_ordered_prefix(s, *held.value) for s in sets]
                cols["shingles"] = _lists(sets)
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return df.mapInArrow(run, schema)


def _common(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles frequent in a share of the texts, ascending, and their ranks by count."""
    some = texts.where(F.pmod(F.hash("text"), F.lit(1_000_000)) < int(ORDER_SHARE * 1_000_000)).select("text").distinct()
    counted = _map_sets(some, None, "shingles array<long>").select(F.explode("shingles").alias("h")).groupBy("h").count().where("count > 1")
    rows = counted.orderBy(F.desc("count"), "h").limit(ORDER_SHINGLES).toPandas()
    by = np.argsort(rows["h"].to_numpy(np.int64))
    return rows["h"].to_numpy(np.int64)[by], (len(rows) - by).astype(np.int64)


_ENOUGH = "9 * (both + greatest(ru, rv)) >= 4 * (nu + nv)"  # what is common lies in both prefixes, or behind that which ends first
_SIZES = "5 * least(nu, nv) >= 4 * greatest(nu, nv)"
_PLACES = "9 * least(nu - pu, nv - pv) >= 4 * (nu + nv)"  # all that is common stands at or behind the first common shingle


def _side(df: DataFrame, x: str, *more: str) -> DataFrame:
    return df.select(*[F.col(c).alias("h" if c == "h" else c[0] + x) for c in ("set_id", "n", "rest", *more)])


def _verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs (su, nu, sv, nv)`` whose whole sets are at 0.8 or more."""
    c = F.col
    ids = pairs.select(c("su").alias("set_id")).union(pairs.select("sv")).distinct()
    need = written(sets.select("set_id", "mark").join(ids, "set_id"), "jaccard-need")
    few = need.count() <= BROADCAST_ROWS
    of = texts.join(F.broadcast(need) if few else need, "mark").groupBy("set_id").agg(F.min("text").alias("text"))
    whole = written(_map_sets(of, None, "set_id long, shingles array<long>"), "jaccard-sets")
    both = pairs.join(whole.select(c("set_id").alias("su"), c("shingles").alias("a")), "su").join(whole.select(c("set_id").alias("sv"), c("shingles").alias("b")), "sv")
    return written(both.where(9 * F.size(F.array_intersect("a", "b")) >= 4 * (c("nu") + c("nv"))).select(c("su").alias("u"), c("sv").alias("v")), "jaccard-links")


def tiled(sets: DataFrame) -> DataFrame:
    """``su, nu, sv, nv``: pairs of sets by their fingerprints, as many as sets at most.

    Of the fingerprints within the radius they are a spanning forest, each link
    within it; sets of one fingerprint meet the first of these.
    """
    c = F.col
    kinds = written(sets.groupBy("fp").agg(F.min_by(F.struct("set_id", "n"), "set_id").alias("s")), "jaccard-prints")
    near = written(simhash.links(kinds.select("fp"), RADIUS, direct=True), "jaccard-tiles")
    of = [kinds.select(c("fp").alias(x), c("s.set_id").alias(f"s{x}"), c("s.n").alias(f"n{x}")) for x in ("u", "v")]
    across = near.join(of[0], "u").join(of[1], "v")
    equal = sets.join(of[0].withColumnRenamed("u", "fp"), "fp").where("set_id != su").withColumn("sv", c("set_id")).withColumn("nv", c("n"))
    return written(across.select("su", "nu", "sv", "nv").unionByName(equal.select("su", "nu", "sv", "nv")).where(_SIZES), "jaccard-near")


def _grouped(shared: DataFrame, found: DataFrame, tag: str) -> DataFrame:
    """``shared`` with each set's ``group`` after links ``(u, v)``."""
    group = components(found).select(F.col("node").alias("set_id"), F.col("root").alias("group"))
    return written(shared.join(group, "set_id", "left").withColumn("group", F.coalesce("group", "set_id")), tag)


def links(sets: DataFrame, texts: DataFrame) -> DataFrame:
    """``(u, v)``: pairs of set ids at 0.8 or more whose closure is that of all.

    ``sets`` has one row a set: ``set_id, mark, fp, n`` and its prefix. First sets
    meet by fingerprints, then each meets one set of another group a shingle of its
    prefix. A pair that is missing after that passes at its first common shingle,
    which then has sets of several groups. Where these are few they meet each
    other, if sizes and places allow for 0.8. The sets of all other such shingles
    are compared among themselves, by prefixes in the order of exact counts. So
    neither a large group of copies nor the texts with a frequent passage are
    compared pair by pair.
    """
    c = F.col
    sets = sets.withColumn("rest", c("n") - F.size("shingles"))
    first = sets.select("set_id", "n", "rest", F.posexplode("shingles").alias("place", "h"))
    shared = written(first.join(first.groupBy("h").count().where("count > 1").select("h"), "h"), "jaccard-shared")
    alike = _verified(tiled(sets), sets, texts)
    near = _grouped(shared, alike, "jaccard-tiled")
    hub = F.min_by(F.struct(c("set_id").alias("su"), c("group").alias("gu")), F.xxhash64(F.pmod("h", F.lit(HUBS)), "set_id")).alias("hub")
    hubs = written(near.groupBy("h").agg(hub, F.min("group").alias("a"), F.max("group").alias("b")).where("a != b").select("h", "hub.*"), "jaccard-hubs")
    drawn = near.join(hubs, "h").where("gu != group").select(F.least("su", "set_id").alias("su"), F.greatest("su", "set_id").alias("sv")).distinct()
    prefix = sets.withColumnRenamed("shingles", "prefix")

    def enough(pairs: DataFrame, tag: str) -> DataFrame:
        met = pairs.join(_side(prefix, "u", "prefix"), "su").join(_side(prefix, "v", "prefix"), "sv").where(_SIZES).withColumn("both", F.size(F.array_intersect("pu", "pv")))
        return written(met.where(_ENOUGH).select("su", "nu", "sv", "nv"), tag)

    some = alike.union(_verified(enough(drawn, "jaccard-drawn"), sets, texts))
    rooted = _grouped(shared, some, "jaccard-rooted")
    open_ = rooted.groupBy("h").agg(F.min("group").alias("a"), F.max("group").alias("b"), F.count("*").alias("df")).where("a != b").select("h", "df")
    apart = written(rooted.join(open_, "h"), "jaccard-apart")
    few = written(apart.where(c("df") <= CROWD), "jaccard-few")
    pairs = _side(few, "u", "group", "place", "h").join(_side(few, "v", "group", "place", "h"), "h").where(f"su < sv and gu != gv and {_SIZES} and {_PLACES}")
    found = some.union(_verified(enough(pairs.select("su", "sv").distinct(), "jaccard-pairs"), sets, texts))
    many = written(apart.where(c("df") > CROWD).select("set_id", "group").distinct(), "jaccard-many")
    return found if many.isEmpty() else found.union(_among(many, sets, texts))


def _among(apart: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """``(u, v)``: pairs at 0.8 or more of sets ``(set_id, group)`` in different groups.

    The prefixes are taken anew, in the order of how many of these sets hold a
    shingle, rarest first, counted over all of them. So what many texts have in
    common stands behind what is their own, and a frequent passage is in the
    prefix of those texts alone that have little else. A shingle of one set makes
    no pair; it only takes its place. Sets go whole to where they meet, so that of
    a crowd whose sets are all somewhat alike only the pairs at 0.8 come out.
    """
    c = F.col
    of = sets.select("set_id", "mark", "n").join(apart, "set_id")
    few = apart.count() <= BROADCAST_ROWS
    found = texts.join(F.broadcast(written(of, "jaccard-apart-marks")) if few else of, "mark").groupBy("set_id", "group", "n").agg(F.min("text").alias("text"))
    whole = written(_map_sets(found, None, "set_id long, group long, n int, shingles array<long>"), "jaccard-apart-sets")
    each = whole.select("set_id", F.explode("shingles").alias("h"))  # read twice: written, it would be as large as the texts
    joint = written(each.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "jaccard-joint")
    listed = F.array_sort(F.collect_list(F.struct("df", "h")))
    held = each.join(joint, "h").groupBy("set_id").agg(listed.alias("late"))
    placed = whole.join(held, "set_id").withColumn("own", c("n") - F.size("late"))
    size = F.expr("n - (4 * n + 4) div 5 + 1")
    carried = F.when(c("n") <= CARRIED, c("shingles")).alias("all")
    early = placed.withColumn("rest", c("n") - size).select("set_id", "group", "n", "rest", "own", carried, F.explode(F.transform(F.slice("late", 1, F.greatest(size - c("own"), F.lit(0))), lambda x, i: F.struct(x["h"].alias("h"), i.alias("i")))).alias("e"))
    early = early.select("set_id", "group", "n", "rest", "all", (c("own") + c("e.i")).cast("int").alias("place"), c("e.h").alias("h"))
    early = written(early.where("9 * (n - place) >= 4 * n + 3.2 * n"), "jaccard-early")  # _PLACES of the smallest set that may be met
    sides = [_side(early, x, "group", "place", "all", "h") for x in ("u", "v")]
    alike = "coalesce(9 * size(array_intersect(au, av)) >= 4 * (nu + nv), true)"
    meet = sides[0].join(sides[1], "h").where(f"su < sv and gu != gv and {_SIZES} and {_PLACES} and {alike}")
    pairs = written(meet.select("su", "nu", "sv", "nv", F.expr("au is not null and av is not null").alias("sure")).distinct(), "jaccard-pairs")
    large = [whole.select(c("set_id").alias(f"s{x}"), c("shingles").alias(y)) for x, y in (("u", "a"), ("v", "b"))]
    both = pairs.where("not sure").join(large[0], "su").join(large[1], "sv").where(9 * F.size(F.array_intersect("a", "b")) >= 4 * (c("nu") + c("nv")))
    return written(pairs.where("sure").select("su", "sv").union(both.select("su", "sv")).select(c("su").alias("u"), c("sv").alias("v")), "jaccard-links")


def marked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc_id, mark, text``: rows of equal id and mark have equal texts."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_mark(text).alias("mark"), text.alias("text"))


def groups(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc_id, mark, root`` of every row: rows of one root are one group."""
    texts = marked(docs, text_col)
    common = _common(texts)
    rows = written(_map_sets(texts, common, "doc_id long, mark string, high long, low long, fp long, n int, shingles array<long>"), "jaccard-rows")
    kinds = rows.groupBy("high", "low").agg(F.min("mark").alias("mark"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    sets = written(kinds.withColumn("set_id", F.monotonically_increasing_id()), "jaccard-kinds")  # a number of its own for each of 128 bits
    linked = components(links(sets.drop("high", "low"), texts)).select(F.col("node").alias("set_id"), "root")
    of = written(sets.select("high", "low", "set_id").join(linked, "set_id", "left").select("high", "low", F.coalesce("root", "set_id").alias("root")), "jaccard-of")
    return rows.select("doc_id", "mark", "high", "low").join(of, ["high", "low"]).select("doc_id", "mark", "root")


def keep_one(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row of each group of similar texts; columns unchanged."""
    found = written(groups(docs, text_col), "jaccard-groups")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "mark")).alias("f")).select("root", F.col("f.doc_id").alias("d"), F.col("f.mark").alias("m"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m"))
    judged = found.join(first, "root").select("doc_id", "mark", same.alias("stays"))
    kept = without_rows(docs, judged.where("not stays").select("doc_id", "mark").distinct(), text_col)
    twice = written(judged.where("stays").groupBy("doc_id", "mark").count().where("count > 1").select("doc_id", "mark"), "jaccard-twice")
    if twice.isEmpty():
        return kept
    names = [F.col(f"`{c}`") for c in docs.columns]
    text = F.col(f"`{text_col}`").cast("string")
    rows = kept.select(F.struct(*names).alias("r"), F.col("doc_id").cast("long").alias("d"), text_mark(text).alias("m"))
    one = rows.join(twice, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("m") == F.col("mark")), "left_semi").groupBy("d", "m").agg(F.max_by("r", F.to_json("r")).alias("r")).select("r.*")  # maps have no order of their own
    return without_rows(kept, twice, text_col).unionByName(one)
