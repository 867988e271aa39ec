"""Benchmark decontamination by winnowing (operator 5).

Every item and every document is cut into words; of each ``gap`` neighbouring
k-grams the one of the smallest hash is kept as fingerprint (the rightmost of
equals). With ``k + gap - 1 = window`` every shared span of ``window`` words
holds a fingerprint that both sides keep, so none is missed. Fingerprints are
joined by a hash join whose build side is the benchmark's index, and every hit
is extended to the windows around it, which are compared word for word.

A benchmark of at most ``block_bytes`` of text, measured first, is broadcast as
one index: one narrow pass over the documents and no shuffle. Of a larger one
nothing is collected: fingerprints of both sides are rows that are joined, and
only the texts with a joint fingerprint are read again, for the windows around
those, which are joined with the benchmark's windows by their words. Both tables
of the benchmark have one row a key. Equal texts are extended once.

Defined results: a null text has no words; an item without words fits nowhere;
an item of fewer than ``window`` words is one window, found by its own length;
an item without ``item_id`` marks words but is not listed; repeated items are
listed once an id; repeated document rows are judged each; texts of any length
are searched whole; other columns of the benchmark are ignored, those of the
documents stay where asked for, whatever their names; an empty table of documents
gives no rows, an empty benchmark no hits.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import BROADCAST_ROWS, map_rows, text_mark, without_rows, written

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Benchmark text in a broadcast index; its arrays take some 40 times that.
BLOCK_BYTES = 4 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def words(text: str | None) -> list[bytes]:
    """Words of ASCII letters, digits and non-ASCII characters, A-Z lowered."""
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def _gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k neighbouring ids; ``_NONE`` where one is unknown (-1)."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(k):
        part = ids[i : i + n]
        known &= part >= 0
        h = (h ^ part.astype(np.uint64)) * _MIX
        h ^= h >> np.uint64(29)
    h = (h * _MIX2) >> np.uint64(1)  # below _NONE
    h[~known] = _NONE
    return h


def winnow(hashes: np.ndarray, gap: int) -> np.ndarray:
    """Positions of the smallest hash in each ``gap`` neighbours, rightmost of equals."""
    n = len(hashes) - gap + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at = hashes[:n].copy(), np.zeros(n, np.int64)
    for i in range(1, gap):
        part = hashes[i : i + n]
        take = part <= least
        least[take] = part[take]
        at[take] = i
    picked = np.unique(at + np.arange(n))
    return picked[hashes[picked] != _NONE]


class Index:
    """Fingerprints and windows of a small benchmark."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int, k: int):
        self.window, self.k, self.gap = window, k, window - k + 1
        self.vocabulary: dict[bytes, int] = {}
        spans: dict[int, dict[tuple, set]] = {}
        prints: list[np.ndarray] = []
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]
            if not ids:
                continue
            width = min(window, len(ids))
            held = spans.setdefault(width, {})
            for i in range(len(ids) - width + 1):
                held.setdefault(tuple(ids[i : i + width]), set()).add(item)
            if width == window:
                grams = _gram_hashes(np.array(ids, np.int64), k)
                prints.append(grams[winnow(grams, self.gap)])
        self.prints = np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64)
        self.tables = {}
        for width, held in spans.items():
            rows = np.array(list(held), np.int64).reshape(-1, width)
            h = _gram_hashes_rows(rows)
            order = np.argsort(h, kind="stable")
            listed = list(held.values())
            self.tables[width] = (h[order], rows[order], [sorted(x for x in listed[i] if x is not None) for i in order])

    def _found(self, ids: np.ndarray, starts: np.ndarray, width: int):
        """(start, window) where the words from start are that window, exactly."""
        h, rows, _ = self.tables[width]
        own = np.lib.stride_tricks.sliding_window_view(ids, width)[starts]
        mine = _gram_hashes_rows(own)
        at = np.searchsorted(h, mine, "left")
        out_s, out_w = [], []
        while True:  # further rows of an equal hash, if ever two windows share one
            ok = at < len(h)
            ok[ok] = h[at[ok]] == mine[ok]
            if not ok.any():
                break
            starts, own, mine, at = starts[ok], own[ok], mine[ok], at[ok]
            same = (rows[at] == own).all(axis=1)
            out_s.append(starts[same])
            out_w.append(at[same])
            at = at + 1
        return (np.concatenate(out_s), np.concatenate(out_w)) if out_s else (np.zeros(0, np.int64),) * 2

    def scan(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
        """For each text: its words, hit spans [start, end) and item ids."""
        ids: list[int] = []
        bounds = []
        get = self.vocabulary.get
        for t in texts:
            ws = words(t)
            bounds.append((len(ids), len(ws)))
            ids.extend([get(w, -1) for w in ws])
            ids.append(-1)  # nothing crosses documents
        seq = np.array(ids, np.int64)
        hits = []
        if self.window in self.tables and len(seq) >= self.window:
            grams = _gram_hashes(seq, self.k)
            picked = winnow(grams, self.gap)
            at = np.searchsorted(self.prints, grams[picked])
            at[at == len(self.prints)] = 0
            picked = picked[self.prints[at] == grams[picked]]
            starts = np.unique((picked[:, None] - np.arange(self.gap)[None, :]).ravel())
            starts = starts[(starts >= 0) & (starts <= len(seq) - self.window)]
            hits.append((self.window, *self._found(seq, starts, self.window)))
        for width in self.tables:
            if width < self.window and len(seq) >= width:
                grams = _gram_hashes(seq, width)
                hits.append((width, *self._found(seq, np.flatnonzero(grams != _NONE), width)))
        cover = np.zeros(len(seq) + 1, np.int32)
        for width, starts, _ in hits:
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + width, -1)
        edge = np.flatnonzero(np.diff(np.r_[0, np.cumsum(cover[:-1]) > 0, 0]))
        runs = edge.reshape(-1, 2)
        begins = np.array([b for b, _ in bounds], np.int64)
        spans: list[list] = [[] for _ in texts]
        for a, b in runs.tolist():
            d = int(np.searchsorted(begins, a, "right")) - 1
            spans[d].append((a - bounds[d][0], b - bounds[d][0]))
        items: list[set] = [set() for _ in texts]
        for width, starts, which in hits:
            listed = self.tables[width][2]
            docs = np.searchsorted(begins, starts, "right") - 1
            for d, w in np.unique(np.stack([docs, which], axis=1), axis=0).tolist() if len(starts) else ():
                items[d].update(listed[w])
        return [(n, s, sorted(i)) for (_, n), s, i in zip(bounds, spans, items, strict=True)]


def _gram_hashes_rows(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(rows), np.uint64)
    for i in range(rows.shape[1]):
        h = (h ^ rows[:, i].astype(np.uint64)) * _MIX
        h ^= h >> np.uint64(29)
    return (h * _MIX2) >> np.uint64(1)


_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5, text_col: str = "text", block_bytes: int = BLOCK_BYTES, marks: bool = False
) -> DataFrame:
    """``doc_id, n_words, spans, items`` for every row of ``docs``.

    ``spans`` are the hit words as disjoint ranges [start, end), ``items`` the
    ids of the items of which a window occurs, in their own type and order. With
    ``marks`` the text's mark goes along.
    """
    own = T.ArrayType(benchmark.schema["item_id"].dataType)
    found = _contamination(docs, benchmark, window, k, text_col, block_bytes, marks)
    return found.withColumn("items", F.array_sort(F.col("items").cast(own)))


def _contamination(docs: DataFrame, benchmark: DataFrame, window: int, k: int, text_col: str, block_bytes: int, marks: bool) -> DataFrame:
    """``contamination`` with ids as strings."""
    pairs = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    text = F.col(f"`{text_col}`").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    size = pairs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > block_bytes:
        found = _joined(texts.withColumn("mark", text_mark(F.col("text"))), pairs, window, k)
        return found if marks else found.drop("mark")
    if marks:
        texts = texts.withColumn("mark", text_mark(F.col("text")))
    keys = [c for c in texts.columns if c != "text"]
    schema = T.StructType([T.StructField(c, T.StringType() if c == "mark" else T.LongType()) for c in keys] + _FOUND)
    index = docs.sparkSession.sparkContext.broadcast(Index([(r["item_id"], r["text"]) for r in pairs.collect()], window, k))

    def make():
        def work(rows):
            found = index.value.scan([r[0] for r in rows])
            return [(*r[1:], *x) for r, x in zip(rows, found, strict=True)]

        return work

    return map_rows(texts.select("text", *keys), make, schema)


def _word_ids(ws: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) >> 1 for w in ws), np.int64, len(ws))


def _kept(ids: np.ndarray, window: int, k: int, widths: list[int]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(width, reach, positions, hashes)`` of a text's fingerprints.

    A fingerprint of a whole window stands for the windows that start up to
    ``reach`` words before it; one of a short item's width for itself.
    """
    out = []
    for width in widths:
        if len(ids) >= width:
            grams = _gram_hashes(ids, k if width == window else width)
            at = winnow(grams, window - k + 1) if width == window else np.arange(len(grams))
            out.append((width, window - k if width == window else 0, at, grams[at]))
    return out


def _joined(texts: DataFrame, pairs: DataFrame, window: int, k: int) -> DataFrame:
    """``contamination`` with ``mark`` by joins, for a benchmark of any size."""

    def item_rows():
        def work(rows):
            out = []
            for text, item in rows:
                ws = words(text)
                width = min(window, len(ws))
                prints = _kept(_word_ids(ws), window, k, [width]) if ws else []
                out += [(item, width, int(h), None) for *_, found in prints for h in np.unique(found)]
                out += [(item, width, None, b" ".join(ws[i : i + width])) for i in range(len(ws) - width + 1) if ws]
            return out

        return work

    c = F.col
    held = written(map_rows(pairs.select("text", "item_id"), item_rows, T.StructType.fromDDL("item string, width int, print long, words binary")), "winnow-items")
    widths = sorted(r[0] for r in held.select("width").distinct().collect())  # at most ``window`` of them
    prints = written(held.where("print is not null").select("print").distinct(), "winnow-prints")
    windows = written(held.where("words is not null").groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items")), "winnow-windows")

    def text_rows():
        def work(rows):
            out = []
            for text, *keys in rows:
                ws = words(text)
                found = [h for *_, h in _kept(_word_ids(ws), window, k, widths)]
                out.append((*keys, len(ws), np.unique(np.concatenate(found)).tolist() if found else []))
            return out

        return work

    own = written(map_rows(texts.select("text", "doc_id", "mark"), text_rows, T.StructType.fromDDL("doc_id long, mark string, n_words long, prints array<long>")), "winnow-texts")
    few = prints.count() <= BROADCAST_ROWS
    joint = own.select("mark", F.explode("prints").alias("print")).join(F.broadcast(prints) if few else prints, "print", "left_semi")
    joint = written(joint.groupBy("mark").agg(F.collect_set("print").alias("joint")), "winnow-joint")
    some = joint.agg(F.sum(F.size("joint") + 4)).first()[0] or 0
    again = texts.join(F.broadcast(joint) if some <= BROADCAST_ROWS else joint, "mark").groupBy("mark").agg(F.min("text").alias("text"), F.first("joint").alias("joint"))

    def window_rows():
        def work(rows):
            out = []
            for text, mark, hits in rows:
                ws = words(text)
                for width, reach, at, h in _kept(_word_ids(ws), window, k, widths):
                    at = at[np.isin(h, np.array(hits, np.uint64))]
                    starts = np.unique((at[:, None] - np.arange(reach + 1)[None, :]).ravel())
                    starts = starts[(starts >= 0) & (starts <= len(ws) - width)]
                    out += [(mark, i, i + width, b" ".join(ws[i : i + width])) for i in starts.tolist()]
            return out

        return work

    near = written(map_rows(again.select("text", "mark", "joint"), window_rows, T.StructType.fromDDL("mark string, start long, end long, words binary")), "winnow-near")
    hits = written(near.join(windows, "words"), "winnow-hits")
    order = Window.partitionBy("mark").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = hits.select("mark", "start", "end").withColumn("opens", F.coalesce(c("start") > before, F.lit(False)).cast("long"))
    runs = opens.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("mark", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = runs.groupBy("mark").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    items = hits.select("mark", "words", "items").distinct().select("mark", F.explode("items").alias("item")).groupBy("mark").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = written(spans.join(items, "mark", "left"), "winnow-found")
    none = "cast(array() as array<struct<start:bigint,end:bigint>>)"
    return own.join(found, "mark", "left").select(
        "doc_id", "mark", "n_words", F.coalesce("spans", F.expr(none)).alias("spans"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark.

    Each row goes by its own text, whatever other rows have its ``doc_id``.
    """
    found = written(contamination(docs, benchmark, marks=True, **options), "winnow").where("size(spans) > 0").select("doc_id", "mark").distinct()
    return without_rows(docs, found, options.get("text_col", "text"))


def digest(found: DataFrame) -> DataFrame:
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        F.expr("aggregate(spans, 0L, (a, x) -> a + x.end - x.start)").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op5_query(spark, sf_dir: str) -> DataFrame:
    return digest(contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
