"""Importance resampling towards a target distribution (operator 13).

Every text becomes a row of a sparse matrix of counts: document by bucket of
hashed word n-grams. The matrix is kept as a table of CSR blocks (row pointers,
bucket indices, counts), each of about a megabyte of text, so texts are read and
hashed once; a row group holds a few blocks, so readers do, too. Column sums of the corpus' and the target's blocks give two smoothed
distributions, their log ratio is each bucket's gain, and the product of the
blocks with the vector of gains weighs the documents. Gumbel noise drawn from
``doc_id`` makes the best scores a sample by weight without replacement.

What reaches the driver are the column sums, one number a bucket; what is
broadcast are the gains, as many. Column sums are added up in a task before they
are shuffled. Ranks come from ranges of the scores, each numbered by itself, so
no task sees more than a range, whatever scores or ids repeat.

Defined results: a null or empty text has no features and weight 0; a null
``doc_id`` draws its noise like one of no digits and stands last among equal
scores; rows that repeat a ``doc_id`` draw the same noise and are ranked each;
texts of any length are read whole, in slices; without target texts, or without
documents, all that is smoothed still gives gains; other columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import map_rows, ranked, written

BUCKETS = 10_000
NGRAM = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Bytes of text whose words are held at once.
SLICE = 1 << 20
#: Blocks of a row group, which is what a task reads at once.
GROUP_BLOCKS = 8
#: Distinct n-grams whose buckets a task remembers.
REMEMBERED = 1 << 18
#: ASCII letters and digits, lower-cased, and all bytes of other characters; the rest separates words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

_LONGS, _INTS = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
_BLOCK = T.StructType([T.StructField(c, _LONGS) for c in ("doc_id", "n_words", "n_features")] + [T.StructField(c, _INTS) for c in ("indptr", "indices", "counts")])


def words_of(data: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text, a slice of about ``size`` bytes at a time."""
    at, n = 0, len(data)
    while at < n:
        to = min(n, at + size)
        part = data[at:to].translate(_WORD_BYTES)
        while to < n and part[-1:] != b" ":  # on to the end of a word
            more = data[to : to + 256].translate(_WORD_BYTES)
            end = more.find(b" ") + 1 or len(more)
            part, to = part + more[:end], to + end
        yield part.split()
        at = to


class _Buckets(dict):
    """n-gram to bucket, remembered within bounds."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, gram: bytes) -> int:
        bucket = zlib.crc32(gram) % self.n
        if len(self) < REMEMBERED:
            self[gram] = bucket
        return bucket


def row_of(data: bytes, buckets: _Buckets, ngram: int = NGRAM, size: int = SLICE) -> tuple[int, np.ndarray, np.ndarray]:
    """Words, buckets in ascending order and their counts."""
    n_words, tail, found = 0, [], []
    for words in words_of(data, size):
        n_words += len(words)
        every = tail + words
        for k in range(1, ngram + 1):
            own = every[max(0, len(tail) - k + 1) :]
            grams = own if k == 1 else [b" ".join(own[i : i + k]) for i in range(len(own) - k + 1)]
            found.append(np.unique(np.fromiter(map(buckets.__getitem__, grams), np.int32, len(grams)), return_counts=True))
        tail = every[max(0, len(every) - ngram + 1) :] if ngram > 1 else []
    if len(found) == 1:
        return n_words, found[0][0], found[0][1]
    if not found:
        return 0, np.zeros(0, np.int32), np.zeros(0, np.int64)
    total = np.zeros(buckets.n, np.int64)
    for where, counts in found:
        total[where] += counts
    where = np.flatnonzero(total)
    return n_words, where, total[where]


def csr_blocks(docs: DataFrame, tag: str, buckets: int = BUCKETS, ngram: int = NGRAM, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The matrix of counts, written as a table of CSR blocks."""

    def make():
        of = _Buckets(buckets)

        def work(rows):
            found = [row_of(data or b"", of, ngram) for _, data in rows]
            indptr = np.concatenate([[0], np.cumsum([len(w) for _, w, _ in found])]).astype(np.int32)
            indices = np.concatenate([w for _, w, _ in found]).astype(np.int32)
            counts = np.concatenate([c for _, _, c in found]).astype(np.int32)
            return [([d for d, _ in rows], [n for n, _, _ in found], [int(c.sum()) for _, _, c in found], indptr, indices, counts)]

        return work

    known = F.col(f"`{id_col}`").cast("long") if id_col in docs.columns else F.lit(None).cast("long")
    texts = docs.select(known.alias("doc_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("data"))
    # Spark's reader decodes up to 4,096 rows of a row group at once, which would be gigabytes of blocks
    return written(map_rows(texts, make, _BLOCK, weigh=1), tag, **{"parquet.block.row.count.limit": GROUP_BLOCKS})


def column_sums(blocks: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of each bucket in all blocks: one number a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(total, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        where = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), pa.array(total[where], pa.int64())], names=["bucket", "n"])

    sums = np.zeros(buckets, np.int64)
    for r in blocks.select("indices", "counts").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket
        sums[r["bucket"]] = r["n"]
    return sums


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's log ratio of smoothed shares, in thousandths, rounded down."""
    n = len(source)
    up = (target + 1).astype(np.float64) * float(source.sum() + n)
    down = (source + 1).astype(np.float64) * float(target.sum() + n)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def weights(blocks: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the blocks times the gains."""
    held = blocks.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, n_words, n_features, indptr, indices, counts = (batch.column(k)[i].values for k in range(6))
                ends = indptr.to_numpy()
                run_sum = np.concatenate([[0], np.cumsum(counts.to_numpy() * held.value[indices.to_numpy()])])
                yield pa.RecordBatch.from_arrays([ids, n_words, n_features, pa.array(run_sum[ends[1:]] - run_sum[ends[:-1]], pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return blocks.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of a document, in thousandths, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(text, 256), F.lit(8)), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, ngram: int = NGRAM, seed: int = SEED, text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document.

    ``rank`` is null where a document is not drawn; the drawn ones are those of
    the best scores, ``percent`` of all that have ``least_words`` words.
    """
    own = csr_blocks(docs, "csr-documents", buckets, ngram, text_col)
    wanted = csr_blocks(target, "csr-target", buckets, ngram, text_col)
    gain = gains(column_sums(own, buckets), column_sums(wanted, buckets))
    scored = weights(own, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    rows = written(scored.withColumn("row", F.monotonically_increasing_id()), "csr-scored")
    fit = F.col("n_words") >= least_words
    n = rows.where(fit).count()
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("row")]
    placed = ranked(rows.where(fit), order, "rank", "csr-ranked")
    placed = placed.withColumn("rank", F.when(F.col("rank") <= percent * n // 100, F.col("rank")))
    return placed.unionByName(rows.where(~fit).withColumn("rank", F.lit(None).cast("long"))).drop("row")


def op13_query(spark, sf_dir: str) -> DataFrame:
    found = resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
