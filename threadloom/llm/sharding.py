"""Sharding by fixed virtual slots (operator 3).

Records are hashed by ``doc_id`` into a fixed number of virtual slots, bytes
and rows are summed a slot, and a small versioned map says which shard holds
which slot. Sizes are balanced over whole slots, heaviest first, so the law is
``bytes``: shards come out near equal, to within about one slot of the lightest. When
the data grow or the number of shards changes, ``rebalance`` edits the map into
its next version by moving few slots; nothing is hashed anew.

A slot that is heavier than ``SPLIT`` of a shard's share (a ``doc_id`` that a
third of the rows repeat) or has more than ``PART_ROWS`` rows is cut into parts,
dealt by id, checksum and size; the map then has a line for each part, and parts
move like slots. Equal texts are under no constraint: the law is about bytes.

The only data that reach the driver are the sums of slots and parts, some
``n_slots`` and one for every ``PART_ROWS`` rows. Everything else is built-in
functions: one pass over the texts gives size and checksum, and a window numbers
the rows of each part. Numbers run on from part to part of a shard by prefix
sums, so no task ever holds a whole shard or a hot slot.

Defined results: a null text has no bytes (size 8, checksum 0); rows without
``doc_id`` are dealt by checksum and size; rows that repeat a ``doc_id`` share
its slot, not always its part; equal texts may be in several shards; texts of any length are one row; other columns
are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import BROADCAST_ROWS, shared_dir, written

SHARDS = 24
SLOTS = 8192
#: Rows of a slot's part, about, and the share of a shard's bytes that a part may have.
PART_ROWS = 1_000_000
SPLIT = 1 / 8


def records(docs: DataFrame, n_slots: int = SLOTS, text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot`` of every row."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text_crc32", "size")).otherwise(F.xxhash64("doc_id"))
    return own.withColumn("virtual_slot", F.pmod(key, F.lit(n_slots)).cast("int"))


def slot_sums(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy("virtual_slot", *by).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def parts_of(sums: dict[int, tuple[int, int]], n_shards: int, part_rows: int = PART_ROWS, split: float = SPLIT) -> dict[int, int]:
    """Slots of more than one part, with their numbers of parts; sums are (bytes, rows)."""
    most = max(1.0, sum(b for b, _ in sums.values()) / n_shards * split)
    need = {s: min(n, max(math.ceil(n / part_rows), math.ceil(b / most))) for s, (b, n) in sums.items()}
    return {s: n for s, n in need.items() if n > 1}


def assign(sums: dict, n_shards: int) -> dict:
    """Slots, or their parts, to shards, heaviest to the lightest shard."""
    loads = [(0, s) for s in range(n_shards)]
    out = {}
    for slot, size in sorted(sums.items(), key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(loads)
        out[slot] = shard
        heapq.heappush(loads, (load + size, shard))
    return out


def rebalance(current: dict, sums: dict, n_shards: int, slack: float = 0.01) -> dict:
    """The next version of a map of slots, or their parts: few move, new ones go where it is light.

    Slots of shards that are no more go first, then slots leave shards over
    the mean by more than ``slack`` for the lightest, as long as that narrows
    the range.
    """
    new = {slot: shard for slot, shard in current.items() if shard < n_shards}
    loads = [0] * n_shards
    for slot, shard in new.items():
        loads[shard] += sums.get(slot, 0)
    homeless = sorted((s for s in set(sums) | set(current) if s not in new), key=lambda s: (-sums.get(s, 0), s))
    for slot in homeless:
        shard = min(range(n_shards), key=lambda s: (loads[s], s))
        new[slot] = shard
        loads[shard] += sums.get(slot, 0)
    mean = sum(loads) / n_shards
    held: list[list] = [[] for _ in range(n_shards)]
    for slot, shard in new.items():
        held[shard].append(slot)
    for _ in range(len(new)):
        heavy = max(range(n_shards), key=lambda s: (loads[s], -s))
        light = min(range(n_shards), key=lambda s: (loads[s], s))
        if loads[heavy] <= mean * (1 + slack):
            break
        gap = loads[heavy] - loads[light]
        fitting = [s for s in held[heavy] if 0 < sums.get(s, 0) < gap]
        if not fitting:
            break
        slot = min(fitting, key=lambda s: (abs(sums[s] - gap / 2), s))
        held[heavy].remove(slot)
        held[light].append(slot)
        new[slot] = light
        loads[heavy] -= sums[slot]
        loads[light] += sums[slot]
    return new


Place = tuple[int, int]  # virtual slot, part


def map_table(spark, version: int, shards: dict[Place, int], rows: dict[Place, int], n_slots: int = SLOTS) -> DataFrame:
    """The map as a table: version, slot, part, parts of the slot, shard, first row.

    ``first`` is where the part's rows begin in its shard. Slots without rows
    have a shard too, so later records find one.
    """
    n_shards = max(shards.values(), default=0) + 1
    at = [0] * n_shards
    parts: dict[int, int] = {}
    for slot, _ in shards:
        parts[slot] = parts.get(slot, 0) + 1
    lines = []
    for slot in range(n_slots):
        for part in range(parts.get(slot, 1)):
            where = shards.get((slot, part), slot % n_shards)
            lines.append((slot, part, parts.get(slot, 1), where, at[where]))
            at[where] += rows.get((slot, part), 0)
    item = lambda k, t: F.element_at(F.split(F.lit(",".join(str(x[k]) for x in lines)), ","), F.col("id").cast("int") + 1).cast(t)
    names = (("virtual_slot", "int"), ("part", "int"), ("parts", "int"), ("shard", "int"), ("first", "long"))
    return spark.range(len(lines)).select(F.lit(version).alias("map_version"), *[item(k, t).alias(c) for k, (c, t) in enumerate(names)])


def stored_map(spark, folder: str) -> tuple[int, dict[Place, int]]:
    """Version and shards of the newest stored map; version 0 where there is none yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return 0, {}
    lines = read_map(spark, folder).collect()  # a row a slot or part
    return max((r["map_version"] for r in lines), default=0), {(r["virtual_slot"], r["part"]): r["shard"] for r in lines}


def store_map(table: DataFrame, folder: str) -> None:
    """Adds a version to the stored map."""
    table.write.mode("append").partitionBy("map_version").parquet(folder)


def read_map(spark, folder: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, the newest by default."""
    every = spark.read.parquet(folder)
    chosen = version if version is not None else every.agg(F.max("map_version")).first()[0]
    return every.where(F.col("map_version") == chosen)


def with_part(rows: DataFrame, parts: dict[int, int], part_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` with the part of the slot that each falls into, by its content.

    So a row finds its part whatever the files' layout. Only rows that more than
    ``part_rows`` others equal are dealt by their number, as they are alike.
    """
    if not parts:
        return rows.withColumn("part", F.lit(0))
    held = F.from_json(F.lit(json.dumps(parts)), "map<string,int>")
    alike = ["doc_id", "text_crc32", "size"]
    many = rows.where(F.col("virtual_slot").isin(list(parts))).groupBy(*alike).count().where(F.col("count") > part_rows)
    many = written(many.select(*[F.col(c).alias(f"{c}_") for c in alike], F.lit(True).alias("many")), "shard-alike")  # a row for part_rows rows at most
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("text_crc32") == F.col("text_crc32_")) & (F.col("size") == F.col("size_"))
    found = rows.join(F.broadcast(many) if many.count() <= BROADCAST_ROWS else many, same, "left").drop(*[f"{c}_" for c in alike])
    key = F.xxhash64(*alike, F.when(F.col("many"), F.col("row")).otherwise(F.lit(0).cast("long")))
    n = F.coalesce(F.try_element_at(held, F.col("virtual_slot").cast("string")), F.lit(1))
    return found.withColumn("part", F.pmod(key, n).cast("int")).drop("many")


def shard(docs: DataFrame, n_shards: int = SHARDS, n_slots: int = SLOTS, folder: str | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Every record with its shard, its place there and its virtual slot.

    With the ``folder`` of a stored map its newest version is edited for these
    records and this number of shards, and stored as the next; without one, or
    in an empty one, the first version is made.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/threadloom/slot-map-{uuid.uuid4().hex}"
    version, current = stored_map(spark, folder)
    rows = written(records(docs, n_slots).withColumn("row", F.monotonically_increasing_id()), "shard-records")
    whole = slot_sums(rows).collect()  # n_slots rows at most
    parts = parts_of({r["virtual_slot"]: (r["bytes"], r["rows"]) for r in whole}, n_shards, part_rows)
    for slot, part in current:
        if part:  # a slot that was cut stays cut
            parts[slot] = max(parts.get(slot, 1), part + 1)
    rows = with_part(rows, parts, part_rows)
    split = slot_sums(rows.where(F.col("virtual_slot").isin(list(parts))), "part").collect() if parts else []  # a row for part_rows rows
    sums = {(r["virtual_slot"], 0): (r["bytes"], r["rows"]) for r in whole if r["virtual_slot"] not in parts}
    sums |= {(s, p): (0, 0) for s, n in parts.items() for p in range(n)} | {(r["virtual_slot"], r["part"]): (r["bytes"], r["rows"]) for r in split}
    sizes = {k: b for k, (b, _) in sums.items()}
    places = rebalance(current, sizes, n_shards) if current else assign(sizes, n_shards)
    store_map(map_table(spark, version + 1, places, {k: n for k, (_, n) in sums.items()}, n_slots), folder)
    lines = read_map(spark, folder, version + 1).drop("parts")
    few = len(sums) <= BROADCAST_ROWS
    placed = rows.join(F.broadcast(lines) if few else lines, ["virtual_slot", "part"])
    in_part = F.expr("row_number() over (partition by virtual_slot, part order by doc_id, text_crc32, size, row)")
    return placed.withColumn("slot", F.col("first") + in_part - 1).drop("row")


def op3_query(spark, sf_dir: str) -> DataFrame:
    found = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
