"""Repeated byte spans by a content-defined difference cover (operator 10).

Every byte covered by a string of ``length`` bytes that also starts anywhere
else in the corpus is removed.

Sampling. A difference cover samples text positions so that any two suffixes
can be compared at a sampled position a bounded step away. Here the cover is
chosen by content: of the k-grams in every ``reach`` neighbouring positions the
one of the smallest hash is sampled (the rightmost of equals). Two equal
windows of ``length`` bytes so sample the same offset, at which both go on
equally for ``length - reach + 1`` bytes. That samples one position in about
``reach / 2`` bytes, where a fixed cover of residues needs many times that.

Names. Sampled positions are named by what follows them, those of a name that
stands once are discarded, and the rest are named again over ever finer
ranges: the whole range of windows that a sampled position answers for, then
blocks of ``block`` windows, then single windows, which are the suffixes
between the samples. A range whose union is repeated is repeated as a whole;
one whose common core stands once holds no repeated window; of equal ranges
one stands for all in the next round. So each round holds what the one before
left open, and copies, of whatever number, weigh as one. Names that decide are
128-bit digests of the bytes themselves, in place of ranks.

Texts of documents with open ranges are read again in the later rounds; spans
found are joined to the documents at the end. All joins are on digests or
document keys with one row a key on one side.

Defined results: a null text is empty; texts shorter than ``length`` have
nothing removed; repeated rows, with or without ``doc_id``, are each other's
copies; texts of any length are read whole, in slices; other columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import map_rows, written

LENGTH = 400


class Cover(NamedTuple):
    """Settings: window length, positions a sample answers for, k-gram, block."""

    length: int = LENGTH
    reach: int = 256
    k: int = 16
    block: int = 32

    @property
    def follow(self) -> int:
        """Bytes after a sampled position that equal windows share for sure."""
        return self.length - self.reach + 1


_SLICE = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        up, down = np.full(size, _ODD, np.uint64), np.full(size, pow(_ODD, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS.clear()
        _POWERS[size] = (np.cumprod(up), np.cumprod(down))
    return _POWERS[size]


def _slice_samples(buf: np.ndarray, cover: Cover) -> np.ndarray:
    """The sampled position of every ``reach`` neighbouring k-grams of ``buf``."""
    n = len(buf) - cover.k + 1
    up, down = _powers(len(buf))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[buf] * up[: len(buf)])])
    h = (total[cover.k :] - total[:n]) * down[:n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    mask = np.uint64((1 << 22) - 1)
    h = (h & ~mask) | (mask - np.arange(n, dtype=np.uint64))  # rightmost of equals
    w = cover.reach
    grid = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    grid[:n] = h
    grid = grid.reshape(-1, w)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    starts = n - w + 1
    return (mask - (np.minimum(ahead[:starts], behind[w - 1 : w - 1 + starts]) & mask)).astype(np.int64)


def samples(buf: np.ndarray, begins: np.ndarray, ends: np.ndarray, cover: Cover) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sample, first window, last window) for all whole windows of all texts.

    ``buf`` holds the texts one after another; text i is [begins[i], ends[i]).
    """
    live = np.zeros(len(buf) + 1, np.int8)
    long_ = ends - begins >= cover.length
    live[begins[long_]] += 1
    live[ends[long_] - cover.length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(live[:-1], dtype=np.int8))
    a, i = [], []
    need = cover.reach + cover.k - 1
    for at in range(0, len(buf), _SLICE):
        own = starts[(starts >= at) & (starts < at + _SLICE)] if len(buf) > _SLICE else starts
        if len(own):
            lo, hi = int(own[0]), int(own[-1])
            found = _slice_samples(buf[lo : hi + need], cover)
            a.append(found[own - lo] + lo)
            i.append(own)
    if not a:
        return (np.zeros(0, np.int64),) * 3
    a, i = np.concatenate(a), np.concatenate(i)
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (i[1:] != i[:-1] + 1)])
    return a[new], i[new], i[np.r_[new[1:], len(i)] - 1]


_KEY = [T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType())]


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(c, T.LongType()) for c in names]


def _pairs(digests: list[bytes]) -> list[list[int]]:
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2).tolist()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _sampled(docs: DataFrame, cover: Cover) -> DataFrame:
    """Round one: every sample with the names of what follows and of its range."""

    def make():
        follow, length = cover.follow, cover.length
        short, long_ = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_digest

        def work(rows):
            texts = [(r[0] or "").encode("utf-8", "surrogatepass") for r in rows]
            line = b"".join(texts)
            ends = np.cumsum([len(t) for t in texts])
            begins = ends - np.array([len(t) for t in texts])
            a, lo, hi = samples(np.frombuffer(line, np.uint8), begins, ends, cover)
            if not len(a):
                return []
            doc = np.searchsorted(ends, a, "right")
            off = begins[doc]
            al, ll, hl = a.tolist(), lo.tolist(), hi.tolist()
            name = [_signed(short(line[x : x + follow])) for x in al]
            whole = _pairs([long_(line[x : y + length], ((s - x) << 20) | (y - x)) for s, x, y in zip(al, ll, hl, strict=True)])
            return [(rows[d][1], rows[d][2], s, x, y, r, *u) for d, s, x, y, r, u in zip(doc.tolist(), (a - off).tolist(), (lo - off).tolist(), (hi - off).tolist(), name, whole, strict=True)]

        return work

    return map_rows(docs, make, T.StructType(_KEY + _longs("a", "lo", "hi", "name", "u1", "u2")))


def _with_open(docs: DataFrame, open_: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Texts of the documents that have open ranges, with their ranges."""
    ranges = open_.groupBy("k1", "k2").agg(F.collect_set(F.struct(*fields)).alias("open"))
    return docs.join(ranges, ["k1", "k2"]).select("text", "k1", "k2", "open")


def _blocks(docs: DataFrame, open_: DataFrame, cover: Cover) -> DataFrame:
    """Round two: blocks of windows, by the name of core and of union."""

    def make():
        length, size = cover.length, cover.block
        short, long_ = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_digest

        def work(rows):
            out, digests = [], []
            for text, k1, k2, ranges in rows:
                line = text.encode("utf-8", "surrogatepass")
                for r in ranges:
                    a, lo, hi = r["a"], r["lo"], r["hi"]
                    for q in range((a - hi) // size, (a - lo) // size + 1):
                        near, far = max(a - hi, q * size), min(a - lo, q * size + size - 1)
                        core = line[a - q * size : a - (q * size + size - 1) + length]
                        out.append((k1, k2, a - far, a - near, _signed(short(core, q + 1))))
                        digests.append(long_(line[a - far : a - near + length], (near << 20) | far))
            return [(*o, *u) for o, u in zip(out, _pairs(digests), strict=True)] if out else []

        return work

    return map_rows(_with_open(docs, open_, ("a", "lo", "hi")), make, T.StructType(_KEY + _longs("lo", "hi", "name", "u1", "u2")))


def _windows(docs: DataFrame, open_: DataFrame, cover: Cover) -> DataFrame:
    """Round three: single windows."""

    def make():
        length, long_ = cover.length, xxhash.xxh3_128_digest

        def work(rows):
            out, digests = [], []
            for text, k1, k2, ranges in rows:
                line = text.encode("utf-8", "surrogatepass")
                for i in sorted({i for r in ranges for i in range(r["lo"], r["hi"] + 1)}):
                    out.append((k1, k2, i))
                    digests.append(long_(line[i : i + length]))
            return [(*o, *u) for o, u in zip(out, _pairs(digests), strict=True)] if out else []

        return work

    return map_rows(_with_open(docs, open_, ("lo", "hi")), make, T.StructType(_KEY + _longs("at", "u1", "u2")), chunk_rows=64)


def _settle(ranges: DataFrame, place: tuple[str, ...], tag: str) -> tuple[DataFrame, DataFrame]:
    """Splits named ranges into (repeated as a whole, still open).

    Ranges of a name that stands once are dropped. Of those left, ranges whose
    union stands twice are repeated; open are the others, and one of each kind
    of repeated ones to stand for it, where a name has several unions.
    """
    where = F.struct("k1", "k2", *place)
    # written first: a join of plain shuffles is one whose hot names Spark can split
    twice = written(ranges.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), f"{tag}-twice")
    left = written(ranges.join(twice, "name"), f"{tag}-left")
    unions = written(left.groupBy("name", "u1", "u2").agg(F.count("*").alias("n"), F.min(where).alias("first")), f"{tag}-unions")
    kinds = written(unions.groupBy("name").agg(F.count("*").alias("kinds")), f"{tag}-kinds")  # counted before the shuffle
    known = written(unions.join(kinds, "name").select("name", "u1", "u2", "n", "kinds", "first"), f"{tag}-known")
    judged = written(left.join(known, ["name", "u1", "u2"]).select("k1", "k2", *place, (F.col("n") > 1).alias("repeated"), ((F.col("kinds") > 1) & ((F.col("n") == 1) | (F.col("first") == where))).alias("open")), f"{tag}-judged")
    return judged.where("repeated"), judged.where("open").select("k1", "k2", *place)


def keyed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``text, k1, k2, doc_id``: rows of one id and text share a key, of 128 bits where there is no id."""
    text = F.col(f"`{text_col}`").cast("string")
    doc = F.col("doc_id").cast("long")
    return docs.select(text.alias("text"), F.coalesce(doc, F.xxhash64(F.lit(1), text)).alias("k1"), F.xxhash64(text, doc.isNull()).alias("k2"), doc.alias("doc_id"))


def repeated_spans(docs: DataFrame, cover: Cover = Cover()) -> DataFrame:
    """``k1, k2, spans``: byte ranges [start, end) of repeated windows, unmerged.

    ``docs`` comes from ``keyed``.
    """
    assert cover.reach + cover.k - 1 <= cover.length and cover.block <= cover.length
    texts = docs.select("text", "k1", "k2").where(F.octet_length("text") >= cover.length)
    first = written(_sampled(texts, cover), "cover")
    whole, open1 = _settle(first, ("a", "lo", "hi"), "cover")
    second = written(_blocks(texts, open1, cover), "cover-blocks")
    blocks, open2 = _settle(second, ("lo", "hi"), "cover-blocks")
    third = written(_windows(texts, open2, cover), "cover-windows")
    twice = third.groupBy("u1", "u2").agg(F.count("*").alias("n")).where("n > 1").select("u1", "u2")
    single = third.join(twice, ["u1", "u2"]).select("k1", "k2", F.col("at").alias("lo"), F.col("at").alias("hi"))
    every = whole.select("k1", "k2", "lo", "hi").union(blocks.select("k1", "k2", "lo", "hi")).union(single)
    return every.groupBy("k1", "k2").agg(F.collect_set(F.struct(F.col("lo").alias("start"), (F.col("hi") + cover.length).alias("end"))).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, cover: Cover = Cover(), text_col: str = "text", keep_bytes: bool = True) -> DataFrame:
    """``doc_id, n_bytes, spans`` and what is left of every document.

    ``kept`` are the remaining bytes (null where not asked for), ``kept_sha256``
    their digest.
    """
    keys = keyed(docs, text_col)
    found = written(repeated_spans(keys, cover), "cover-spans")
    rows = keys.join(found, ["k1", "k2"], "left").select("text", "doc_id", "spans")
    span = T.ArrayType(T.StructType(_longs("start", "end")))
    schema = T.StructType([*_longs("doc_id", "n_bytes", "n_removed"), T.StructField("spans", span), T.StructField("kept", T.BinaryType()), T.StructField("kept_sha256", T.StringType())])

    def make():
        def work(rows):
            out = []
            for text, doc, spans in rows:
                line = (text or "").encode("utf-8", "surrogatepass")
                gone = merged([(s["start"], s["end"]) for s in spans or ()])
                kept, at = [], 0
                for a, b in gone:
                    kept.append(line[at:a])
                    at = b
                kept.append(line[at:])
                left = b"".join(kept)
                out.append((doc, len(line), len(line) - len(left), [{"start": a, "end": b} for a, b in gone], left if keep_bytes else None, hashlib.sha256(left).hexdigest()))
            return out

        return work

    return map_rows(rows, make, schema)


def op10_query(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_bytes=False)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
