"""SimHash near-duplicates by tiled exact comparison (operator 7).

Fingerprints are made where the texts lie (one narrow pass, nothing but
``doc_id`` and 8 bytes leave it). Distinct fingerprints are dealt by hash into
blocks; each pair of blocks is one task that compares tiles with numpy
exclusive-or and bit counts. A tile holds the fingerprints of one vector of
bit counts (of the four quarters); a pair of tiles is skipped where the vectors
differ, summed over the quarters, by more than the radius, as then no pair inside
can be within it. The comparison is exact: every pair of distinct fingerprints
is either compared or excluded by its bit counts.

Tasks emit a spanning forest of the links they find, never all pairs of a
group; a distributed star contraction joins the forests.

Defined results: a null or empty text has no words and the zero fingerprint,
which links like any other; a null ``doc_id`` keeps its row and is passed over
when the smallest id of a component is chosen (null if there is no other);
repeated rows come out repeatedly; texts of any length are taken whole, their
shingles counted in slices; other columns are ignored, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import map_rows, without, written

SEED = 42


def simhash64(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash over word shingles, repeats counted; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        digests = xxhash.xxh64_digest(b" ".join(words), SEED)
    else:
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[: len(words) - shingle]]).tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)])
    return majority(digests)


def majority(digests: bytes) -> int:
    """Each of 64 bits that more than half of the 8-byte digests have."""
    n = len(digests) // 8
    raw = np.frombuffer(digests, np.uint8).reshape(n, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        counts += np.unpackbits(raw[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, fp``: fp is the fingerprint as a signed long."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])

    def make():
        def work(rows):
            return [(d, h - (1 << 64) if h >> 63 else h) for d, h in ((d, simhash64(t, shingle)) for d, t in rows)]

        return work

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col(f"`{text_col}`").cast("string").alias("text")), make, schema, weigh=1)


def _bit_counts(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int16)


class _Tiles:
    """Fingerprints sorted into tiles of equal bit-count vectors."""

    def __init__(self, fps: np.ndarray):
        counts = _bit_counts(fps)
        order = np.lexsort(counts.T[::-1])
        self.fps, counts = fps[order], counts[order]
        new = np.flatnonzero(np.r_[True, (counts[1:] != counts[:-1]).any(axis=1)]) if len(fps) else np.zeros(0, np.int64)
        self.first, self.last = new, np.r_[new[1:], len(fps)].astype(np.int64)
        self.vectors = counts[new]
        self.total = self.vectors.sum(axis=1)
        self.by_total = {int(t): np.flatnonzero(self.total == t) for t in np.unique(self.total)}


def _near_pairs(a: _Tiles, b: _Tiles, same: bool, radius: int, budget: int = 1 << 20):
    """Yields index arrays (into a.fps, b.fps) of pairs within the radius.

    A tile of ``a`` meets all tiles of ``b`` that it cannot skip at once, in
    matrices of at most ``budget`` pairs.
    """
    for total, mine in a.by_total.items():
        near = [b.by_total[t] for t in range(total - radius, total + radius + 1) if t in b.by_total]
        if not near:
            continue
        theirs = np.sort(np.concatenate(near))
        vectors, first, sizes = b.vectors[theirs], b.first[theirs], (b.last - b.first)[theirs]
        for i in mine.tolist():
            apart = np.abs(vectors - a.vectors[i]).sum(axis=1)
            meet = np.flatnonzero((apart <= radius) & (theirs >= i) if same else apart <= radius)
            if not len(meet):
                continue
            n = sizes[meet]
            rows = np.repeat(first[meet] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            other = b.fps[rows]
            lo, hi = int(a.first[i]), int(a.last[i])
            for y0 in range(0, len(rows), budget):
                part = other[y0 : y0 + budget]
                step = max(1, budget // len(part))
                for x0 in range(lo, hi, step):
                    x, y = np.nonzero(np.bitwise_count(a.fps[x0 : min(hi, x0 + step), None] ^ part[None, :]) <= radius)
                    if len(x):
                        yield x + x0, rows[y + y0]


def _merge(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the sets of x[i] and y[i]; parent stays flat (roots only)."""
    while len(x):
        rx, ry = parent[x], parent[y]
        open_ = rx != ry
        x, y, rx, ry = x[open_], y[open_], rx[open_], ry[open_]
        if not len(x):
            return
        np.minimum.at(parent, np.maximum(rx, ry), np.minimum(rx, ry))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def _tree(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Joins the sets of x[i] and y[i] like ``_merge``; yields those pairs that do it, fewer than the sets."""
    while True:
        rx, ry = parent[x], parent[y]
        open_ = rx != ry
        x, y = x[open_], y[open_]
        if not len(x):
            return
        one = np.unique(np.maximum(rx, ry)[open_], return_index=True)[1]  # a pair for each larger root leads to a smaller one
        yield x[one], y[one]
        _merge(parent, x[one], y[one])


def _forest(left: bytes, right: bytes | None, radius: int, direct: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Star links (member, smallest) among the fingerprints of two blocks, or ``direct``: links of pairs within the radius."""
    a = _Tiles(np.frombuffer(left, np.uint64))
    b = a if right is None else _Tiles(np.frombuffer(right, np.uint64))
    shift = 0 if right is None else len(a.fps)
    parent = np.arange(shift + len(b.fps))
    every = a.fps if right is None else np.concatenate([a.fps, b.fps])
    if direct:
        found = [pair for x, y in _near_pairs(a, b, right is None, radius) for pair in _tree(parent, x, y + shift)]
        us, vs = (np.concatenate([np.zeros(0, np.int64), *side]) for side in ([u for u, _ in found], [v for _, v in found]))
        return every[us], every[vs]
    for x, y in _near_pairs(a, b, right is None, radius):
        _merge(parent, x, y + shift)
    child = np.flatnonzero(parent != np.arange(len(parent)))
    return every[child], every[parent[child]]


def links(distinct: DataFrame, radius: int = 3, block_rows: int = 1 << 16, direct: bool = False) -> DataFrame:
    """Spanning links ``(u, v)`` of distinct fingerprints within ``radius``; ``direct``: u and v themselves are within it.

    ``distinct`` has one column ``fp``. Blocks hold ``block_rows`` rows on
    average; with n blocks each block meets every other once, so the data
    moved are n times 8 bytes a fingerprint and the work is that of all pairs
    less the skipped tiles.
    """
    spark = distinct.sparkSession
    n = max(1, -(-distinct.count() // block_rows))
    packed = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("fps", T.BinaryType())])

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "fps": [np.sort(pdf["fp"].to_numpy(np.int64)).tobytes()]})

    blocks = written(
        distinct.select(F.pmod(F.xxhash64("fp"), F.lit(n)).cast("int").alias("block"), "fp").groupBy("block").applyInPandas(pack, packed), "simhash-blocks"
    )
    pairs = spark.range(n).select(F.col("id").cast("int").alias("i")).select("i", F.explode(F.sequence(F.col("i"), F.lit(n - 1))).alias("j"))
    both = (
        pairs.join(blocks.select(F.col("block").alias("i"), F.col("fps").alias("a")), "i")
        .join(blocks.select(F.col("block").alias("j"), F.col("fps").alias("b")), "j")
        .select("i", "j", "a", F.when(F.col("i") != F.col("j"), F.col("b")).alias("b"))
        .repartition(max(1, min(n * (n + 1) // 2, 4096)), "i", "j")
    )
    edge = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])

    def make():
        def work(rows):
            out = []
            for _, _, a, b in rows:
                u, v = _forest(a, b, radius, direct)
                out += zip(u.view(np.int64).tolist(), v.view(np.int64).tolist(), strict=True)
            return out

        return work

    return map_rows(both, make, edge, weigh=2, chunk_rows=1)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node in ``edges (u, v)``: root is the smallest.

    Large-star and small-star contraction. Minima are aggregates with map-side
    combining, and the joins have the minima, one row a node, on one side and
    plain tables on both, so a hub of any degree can be split over tasks. Each
    step is written to the shared folder, which bounds the lineage. Rounds go on
    until one changes nothing, which they are sure to reach.
    """
    e = F.col
    now = written(edges.where(e("u") != e("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    mark = None
    while True:
        # large star: larger neighbours link to the smallest neighbour
        both = now.union(now.select("v", "u"))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
        big = written(both.where(e("v") > e("u")).join(least, "u").select(e("v").alias("u"), e("m").alias("v")).distinct(), "cc-big")
        # small star: smaller neighbours and the node link to the smallest
        least = written(big.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        small = big.join(least, "u").select(e("v").alias("u"), e("m").alias("v")).where(e("u") != e("v")).union(least.select("u", "m"))
        now = written(small.distinct(), "cc")
        seen = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(pmod(xxhash64(v, u), 1000000007) as decimal(38,0)))")).first()
        if mark == tuple(seen):
            break
        mark = tuple(seen)
    roots = now.select(e("v").alias("node"), e("v").alias("root")).distinct()
    return now.select(e("u").alias("node"), e("v").alias("root")).unionByName(roots)


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3, text_col: str = "text", block_rows: int = 1 << 16) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``."""
    marks = written(fingerprints(docs, text_col, shingle), "simhash")
    kinds = written(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-kinds")
    found = components(links(kinds.select("fp"), radius, block_rows))
    rooted = written(kinds.join(found.withColumnRenamed("node", "fp"), "fp"), "simhash-rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    of = written(kinds.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id")), "simhash-of")
    return marks.join(of, "fp").select("doc_id", "fp", "component_id")


def op7_query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
