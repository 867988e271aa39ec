"""Helpers shared by the operators: durable tables and Arrow batch plumbing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.operators.durable import shared_dir, written

__all__ = ["columns_of", "fresh", "map_rows", "ranked", "shared_dir", "text_mark", "without", "without_rows", "written"]

#: Bytes of text that a Python worker holds at once, besides the batch itself.
CHUNK_BYTES = 1 << 20


def fresh(name: str, taken: list[str]) -> str:
    """A column name that is not taken, whatever the case of its letters."""
    used = {c.lower() for c in taken}
    name = f"__{name}"
    while name.lower() in used:
        name += "_"
    return name


def columns_of(df: DataFrame, fallback: dict[str, str]) -> DataFrame:
    """``df`` with the named columns, typed; absent ones come as nulls."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in fallback.items()])


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[[list[tuple]], list[tuple]]],
    schema: T.StructType,
    weigh: int = 0,
    chunk_bytes: int = CHUNK_BYTES,
    chunk_rows: int = 1024,
) -> DataFrame:
    """Map rows through Python in bounded chunks over Arrow.

    ``make`` builds, once per task, a function from a list of row tuples to a
    list of output tuples. A chunk holds at most ``chunk_rows`` rows and, but
    for a single longer row, ``chunk_bytes`` characters of column ``weigh``.
    """
    names = df.columns
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for rows in _chunks(batch, len(names), weigh, chunk_bytes, chunk_rows):
                out = work(rows)
                if out:
                    cols = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, arrow.types, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def _chunks(batch: pa.RecordBatch, width: int, weigh: int, chunk_bytes: int, chunk_rows: int) -> Iterator[list[tuple]]:
    start, n = 0, batch.num_rows
    lengths = None
    col = batch.column(weigh)
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) or pa.types.is_binary(col.type):
        import pyarrow.compute as pc

        lengths = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    while start < n:
        stop = min(n, start + chunk_rows)
        if lengths is not None:
            total, stop2 = 0, start
            while stop2 < stop and (stop2 == start or total + lengths[stop2] <= chunk_bytes):
                total += lengths[stop2]
                stop2 += 1
            stop = stop2
        part = batch.slice(start, stop - start)
        yield list(zip(*[part.column(i).to_pylist() for i in range(width)], strict=True))
        start = stop


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


#: Ids that a broadcast may hold: 8 bytes each, some 20 MB hashed.
BROADCAST_ROWS = 500_000


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is not in ``ids`` (one column, distinct).

    The ids are counted first: up to ``BROADCAST_ROWS`` they are broadcast and
    the texts stay where they are, beyond that both sides are shuffled. Rows
    with a null ``doc_id`` stay.
    """
    few = ids.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def text_mark(text: Column) -> Column:
    """Equal for equal texts: the 128-bit digest, empty for a null text."""
    return F.coalesce(F.md5(text.cast("string")), F.lit(""))


def without_rows(docs: DataFrame, gone: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that are not in ``gone (doc_id, mark)``, distinct rows.

    Like ``without``, but by id and text: other texts of an id stay, and rows
    without ``doc_id`` are told apart by their texts.
    """
    few = gone.count() <= BROADCAST_ROWS
    ids = gone.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (text_mark(F.col(f"`{text_col}`")) == F.col("__mark"))
    return docs.join(F.broadcast(ids) if few else ids, same, "left_anti")


def ranked(df: DataFrame, order: list[Column], name: str, tag: str) -> DataFrame:
    """``df`` with each row's number in ``order`` over all rows, from 1, as column ``name``.

    Rows are dealt by ranges of the order and numbered in each range; what is
    added is the number of rows before a range, of which there are as many as
    shuffle partitions. No task holds more than a range, if ``order`` tells equal
    rows apart. ``df`` is read twice, so it should be a written table.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at, part, before = fresh("at", df.columns), fresh("part", df.columns), fresh("before", df.columns)
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    rows = written(dealt.withColumn(part, F.shiftright(at, 33)), tag)
    ranges = rows.groupBy(part).agg(F.count("*").alias(before))  # as many as partitions
    firsts = ranges.select(part, F.expr(f"coalesce(sum({before}) over (order by {part} rows between unbounded preceding and 1 preceding), 0)").alias(before))
    number = F.col(before) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.join(F.broadcast(firsts), part).withColumn(name, number.cast("long")).drop(at, part, before)
