"""Archives of any size, read by many tasks.

Spark's text reader cuts a file wherever it likes and starts a record behind the
next ``}``, so one long line is no obstacle and any store it reads will do. Records
are gathered into chunks of about a megabyte, written once. Of each chunk is known
by itself how many quotes it has and how deep its brackets go, both for a start
inside and outside a string; sums of these over a file's earlier chunks tell how
each chunk starts, and the last section that an earlier one opened is carried to
it the same way. From there on every chunk stands alone: entries of the long
sections are cut out of it, entries across a border are put together from their
pieces, and what is left, with ``null`` where entries stood, is a short document
of the same shape that the plain reader takes.

A file of one chunk, the usual case, starts outside everything and is joined to
nothing. Windows and joins over the other chunks hold numbers only; a chunk's text
is joined to its start, broadcast if there are few.

Defined results: those of ``archives`` on the whole text. A file is quarantined if
its short document or any of its entries is no JSON, with all its rows; an empty
file is no JSON; a section that is no list has no entries; a section's name written
with escapes is read with the short document; folders without files give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.operators.durable import written
from threadloom.sources import archives

#: Sections whose entries are cut out.
CUT = ("tweets", "community-tweet", "note-tweet", "like", "follower", "following")
CHUNK_BYTES = 1 << 20
#: Chunks whose starts are broadcast: some 30 bytes each.
BROADCAST_CHUNKS = 500_000
_ESCAPE = re.compile(rb"\\.", re.S)
_KEY = re.compile(rb'"([^"\\]{1,64})"\s*:\s*\Z')

_CHUNK = "path string, name string, file_size long, start long, seq long, n_bytes long, quotes long, deep_out long, deep_in long, data binary"


class Split(NamedTuple):
    """``archives`` as the plain reader gives them, but for cut sections, and the entries of these."""

    archives: DataFrame
    entries: DataFrame


class _Brackets(NamedTuple):
    """Brackets outside strings: place, +1 or -1, the byte, depth behind each."""

    at: np.ndarray
    step: np.ndarray
    byte: np.ndarray
    depth: np.ndarray


def _plain(data: bytes) -> np.ndarray:
    """The bytes, with escapes blotted out."""
    return np.frombuffer(_ESCAPE.sub(b"__", data) if b"\\" in data else data, np.uint8)


def _summary(data: bytes) -> tuple[int, int, int]:
    """Quotes modulo 2, and by how much brackets deepen from outside and from inside a string."""
    flat = _plain(data)
    inside = np.cumsum(flat == 34) & 1
    step = np.isin(flat, (123, 91)).astype(np.int64) - np.isin(flat, (125, 93))
    return int(inside[-1]) if len(flat) else 0, int(step[inside == 0].sum()), int(step[inside == 1].sum())


def _brackets(data: bytes, inside: int, depth: int) -> _Brackets:
    flat = _plain(data)
    out = ((np.cumsum(flat == 34) + inside) & 1) == 0
    at = np.flatnonzero(out & np.isin(flat, (123, 91, 125, 93)))
    byte = flat[at]
    step = np.where((byte == 123) | (byte == 91), 1, -1)
    return _Brackets(at, step, byte, depth + np.cumsum(step))


def _section(data: bytes, at: int, byte: int) -> str:
    """The cut section that a bracket at the second level opens, else ''."""
    key = _KEY.search(data[max(0, at - 128) : at]) if byte == 91 else None
    name = key[1].decode("utf-8", "replace") if key else ""
    return name if name in CUT else ""


def last_section(data: bytes, inside: int, depth: int) -> str | None:
    """The section that the chunk opens last; null if it opens none at the second level."""
    b = _brackets(data, inside, depth)
    opened = np.flatnonzero((b.step > 0) & (b.depth == 2))
    return _section(data, int(b.at[opened[-1]]), int(b.byte[opened[-1]])) if len(opened) else None


def cut(data: bytes, inside: int, depth: int, section: str) -> tuple[list[tuple[str, str, bytes]], bytes]:
    """``(role, section, text)`` of a chunk's entries, and the chunk without them.

    The role is entry, or head, middle or tail of one that crosses a border.
    """
    b = _brackets(data, inside, depth)
    found: list[tuple[str, str, bytes]] = []
    rest: list[bytes] = []
    begin = 0 if section and depth >= 3 else None  # of the entry that is open
    role, kept, blank = "tail", 0, False
    for i in np.flatnonzero(((b.step > 0) & ((b.depth == 2) | (b.depth == 3))) | ((b.step < 0) & (b.depth == 2))):
        at = int(b.at[i])
        if b.step[i] < 0:
            if begin is not None:
                found.append((role, section, data[begin : at + 1]))
                begin, kept = None, at + 1
        elif b.depth[i] == 2:
            section = _section(data, at, int(b.byte[i]))
        elif section:
            between = data[kept:at]
            if not (blank and between.strip(b" \t\r\n") == b","):  # one null stands for a run of entries
                rest += [between, b"null"]
            begin, role, blank = at, "entry", True
    if begin is None:
        rest.append(data[kept:])
    else:
        found.append(("middle" if role == "tail" else "head", section, data[begin:]))
    return found, b"".join(rest)


def _chunks(spark: SparkSession, path: str, glob: str, name: str | None, chunk_bytes: int) -> DataFrame:
    raw = spark.read.text(path, lineSep="}", pathGlobFilter=glob, recursiveFileLookup=True)
    at = [F.col("_metadata.file_path").alias("path"), F.expr(name or "_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("file_size"), F.col("_metadata.file_block_start").alias("start")]
    rows = raw.select(*at, F.col("value").cast("binary").alias("value"))
    rows = rows.withColumn("split", F.xxhash64("path", "start"))  # told apart from its neighbour by this alone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head, parts, size, seq = None, None, [], 0, 0

        def chunk() -> pa.RecordBatch:
            data = b"}".join(parts) + b"}"
            row = (*head, seq, len(data), *_summary(data), data)
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 7, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=[c.split()[0] for c in _CHUNK.split(", ")])

        for batch in batches:
            splits = batch.column(5).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(splits)) + 1).tolist(), len(splits)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if key != splits[a]:
                    if parts:
                        yield chunk()
                    key, head, parts, size, seq = splits[a], tuple(batch.column(k)[a].as_py() for k in range(4)), [], 0, 0
                for value in batch.column(4).slice(a, b - a).to_pylist():
                    if parts and size + len(value) >= chunk_bytes:
                        yield chunk()
                        parts, size, seq = [], 0, seq + 1
                    parts.append(value)
                    size += len(value) + 1
        if parts:
            yield chunk()

    return written(rows.mapInArrow(run, _CHUNK), "archive-chunks")


def _starts(chunks: DataFrame) -> DataFrame:
    """``path, start, seq, inside, depth, section, phantom`` of the chunks of files with several.

    ``phantom`` marks a last chunk to which a ``}`` was added that the file lacks.
    """
    c = F.col
    of_file = Window.partitionBy("path").orderBy("start", "seq")
    before = of_file.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2))
    sized = chunks.drop("data", "name").withColumn("inside", inside).withColumn("deep", F.when(c("inside") == 0, c("deep_out")).otherwise(c("deep_in")))
    sized = sized.withColumn("depth", F.coalesce(F.sum("deep").over(before), F.lit(0)))
    total = F.sum("n_bytes").over(Window.partitionBy("path"))
    phantom = F.lead("seq").over(of_file).isNull() & (total > c("file_size"))
    numbers = written(sized.withColumn("phantom", phantom).select("path", "start", "seq", "inside", "depth", "phantom"), "archive-starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [last_section(*(batch.column(k)[i].as_py() for k in (5, 3, 4))) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(own, pa.string())], names=["path", "start", "seq", "opened"])

    opened = _joined(chunks, numbers).select("path", "start", "seq", "inside", "depth", "data").mapInArrow(run, "path string, start long, seq long, opened string")
    carried = numbers.join(written(opened, "archive-opened"), ["path", "start", "seq"])
    return written(carried.withColumn("section", F.coalesce(F.last("opened", ignorenulls=True).over(before), F.lit(""))).drop("opened"), "archive-starts")


def _joined(chunks: DataFrame, starts: DataFrame) -> DataFrame:
    few = starts.count() <= BROADCAST_CHUNKS
    return chunks.join(F.broadcast(starts) if few else starts, ["path", "start", "seq"])


def _pieces(chunks: DataFrame) -> DataFrame:
    """Roles, sections and texts of the entries, and what is left of each chunk (role rest); written, so chunks are cut once."""
    names = ["path", "start", "seq", "ord", "role", "section", "text"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for i in range(batch.num_rows):
                path, start, seq, inside, depth, section, phantom, data = (batch.column(k)[i].as_py() for k in range(8))
                found, rest = cut(data[:-1] if phantom else data, inside, depth, section)
                rows += [(path, start, seq, k, *x) for k, x in enumerate([*found, ("rest", None, rest)])]
                size += len(data)
                if size >= CHUNK_BYTES or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows, size = [], 0

    own = chunks.select("path", "start", "seq", "inside", "depth", "section", "phantom", "data")
    return written(own.mapInArrow(run, "path string, start long, seq long, ord long, role string, section string, text binary").withColumn("text", F.col("text").cast("string")), "archive-pieces")


def _in_order(pieces: DataFrame, *by: str) -> DataFrame:
    """Texts of a group, put together in the order of the file."""
    listed = F.array_sort(F.collect_list(F.struct("start", "seq", "ord", "text")))
    return pieces.groupBy(*by).agg(F.array_join(F.transform(listed, lambda x: x["text"]), "").alias("text"))


def read(spark: SparkSession, path: str, glob: str = "*_archive.json", name: str | None = None, chunk_bytes: int = CHUNK_BYTES) -> Split:
    """All archives under ``path``; ``name`` is the file's own unless given as a SQL expression of ``_metadata``."""
    c = F.col
    chunks = _chunks(spark, path, glob, name, chunk_bytes)
    whole = (c("start") == 0) & (c("seq") == 0) & (c("n_bytes") >= c("file_size"))
    alone = chunks.where(whole).select("path", "start", "seq", F.lit(0).cast("long").alias("inside"), F.lit(0).cast("long").alias("depth"), F.lit("").alias("section"), (c("n_bytes") > c("file_size")).alias("phantom"), "data")
    parts = chunks.where(~whole)
    known = alone.unionByName(_joined(parts, _starts(parts)).select(*alone.columns))
    found = _pieces(known)
    across = found.where("role in ('head', 'middle', 'tail')")  # two a chunk at most
    nth = F.count_if(c("role") == "head").over(Window.partitionBy("path").orderBy("start", "seq", "ord").rowsBetween(Window.unboundedPreceding, 0))
    joined = _in_order(across.withColumn("nth", nth).withColumn("section", F.first("section").over(Window.partitionBy("path", "nth").orderBy("start", "seq", "ord"))), "path", "nth", "section")
    entries = found.where("role = 'entry'").select("path", "section", "text").unionByName(joined.select("path", "section", "text"))
    entries = entries.withColumn("text", F.replace("text", F.lit('"tWeetId"'), F.lit('"tweetId"')))
    bad = entries.where(F.try_parse_json("text").isNull()).select("path").distinct()
    names = chunks.where("start = 0 and seq = 0").select("path", c("name").alias("archive_file"))
    short = _in_order(found.where("role = 'rest'"), "path").join(names, "path").select("archive_file", "path", c("text").alias("raw"))
    read_ = archives.parse_archives(short)
    judged = read_.join(bad.withColumn("bad", F.lit(True)), "path", "left").withColumn("corrupt", c("corrupt") | F.coalesce("bad", F.lit(False))).drop("bad")
    return Split(written(judged.select(*read_.columns), "archive-short"), entries)


def source_tweets(split: Split) -> DataFrame:
    """All posts and likes of all archives as rows of 23 columns."""
    return archives.rows_of(archives.owners(split.archives), split.entries)
