"""Fill-in-middle transformation by a sparse checkpoint index (operator 11).

A text is cut twice at borders of units (lines or code points) into prefix,
middle and suffix, and these are put together anew between sentinels. Its units
must be counted before the cuts are known, so one pass over the bytes counts
them and leaves checkpoints: every ``STRIDE`` units, and at the last border of
every ``BLOCK`` bytes, how many units, bytes and code points lie before. A cut is
found by binary search among the checkpoints and a rescan from the one before
it, which reads less than ``STRIDE`` units and ``BLOCK`` bytes more than the unit
that the cut ends. No list of units is ever built, and the text is never decoded.

The cuts, the form and whether a text is changed at all come from the digest of
seed and ``doc_id``, so every run agrees and rows need not meet: nothing is
shuffled. ``restored`` turns an output back into its text by built-in functions.

Defined results: a null text is empty; an empty text, and one that holds a
sentinel, stays plain, so that outputs can be read back; a null ``doc_id`` counts
as no digits; rows that repeat a ``doc_id`` are cut at the same draws, each by
its own number of units; texts of any length are taken whole, a single unit of
any length too; bytes that are no UTF-8 are kept; other columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRIDE = 256
BLOCK = 1 << 16
SEED = 7


class Sentinels(NamedTuple):
    """Marks before prefix, suffix and middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def check(self) -> Sentinels:
        """Refuses marks of which one could begin inside another, or inside text beside one."""
        for i, a in enumerate(self):
            for j, b in enumerate(self):
                if not a or (i != j and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"sentinels overlap: {a!r}, {b!r}")
        return self


class Index(NamedTuple):
    """Checkpoints, ascending, and what the whole text has."""

    units: list[int]
    at: list[int]
    chars: list[int]
    n_units: int
    n_chars: int


def _leads(view: np.ndarray) -> np.ndarray:
    """Where a code point begins."""
    return (view & 0xC0) != 0x80


def _borders(view: np.ndarray, lead: np.ndarray, unit: str) -> np.ndarray:
    """Places in a block at which a unit ends before the text does."""
    if unit == "line":
        return np.flatnonzero(view == 10) + 1
    return np.flatnonzero(lead)


def checkpoints(data: bytes, unit: str = "line", stride: int = STRIDE, block: int = BLOCK) -> Index:
    """One counting pass over the bytes of a text."""
    units, at, chars = [0], [0], [0]
    n_units = n_chars = 0
    last = 0  # the last border so far
    for begin in range(0, len(data), block):
        view = np.frombuffer(data, np.uint8, min(block, len(data) - begin), begin)
        lead = _leads(view)
        ends = _borders(view, lead, unit)
        if begin == 0 and len(ends) and ends[0] == 0:  # nothing lies before the first code point
            ends = ends[1:]
        if len(ends):
            first = (-n_units - 1) % stride  # the first border that completes a stride
            picked = np.arange(first, len(ends), stride)
            if not len(picked) or picked[-1] != len(ends) - 1:
                picked = np.append(picked, len(ends) - 1)
            units += (n_units + picked + 1).tolist()
            at += (begin + ends[picked]).tolist()
            chars += (n_chars + np.concatenate([[0], np.cumsum(lead)])[ends[picked]]).tolist()
            n_units += len(ends)
            last = begin + int(ends[-1])
        n_chars += int(np.count_nonzero(lead))
    if last < len(data):  # the last unit has no border of its own
        n_units += 1
    return Index(units, at, chars, n_units, n_chars)


def cut(data: bytes, index: Index, n: int, unit: str = "line") -> tuple[int, int]:
    """Bytes and code points of the first ``n`` units."""
    if n >= index.n_units:
        return len(data), index.n_chars
    k = bisect_right(index.units, n) - 1
    at, chars, left = index.at[k], index.chars[k], n - index.units[k]
    begin = at
    if unit == "line":
        for _ in range(left):
            at = data.index(b"\n", at) + 1
    else:
        while left:
            at += 1
            left -= (data[at] & 0xC0) != 0x80
    return at, chars + int(np.count_nonzero(_leads(np.frombuffer(data, np.uint8, at - begin, begin))))


class Rule(NamedTuple):
    unit: str = "line"
    rate: int = 100
    spm: int = 50
    seed: int = SEED
    marks: Sentinels = Sentinels()


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """h1 to h4: the first four 8-digit groups of the digest."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4)]


def transformed(doc_id: int | None, data: bytes, rule: Rule = Rule()) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle, output."""
    index = checkpoints(data, rule.unit)
    h1, h2, h3, h4 = draws(doc_id, rule.seed)
    p, s, m = (x.encode() for x in rule.marks)
    if not data or any(x in data for x in (p, s, m)) or h3 % 100 >= rule.rate:
        return index.n_units, "plain", None, None, data
    a, b = sorted((h1 % (index.n_units + 1), h2 % (index.n_units + 1)))
    (a, chars_a), (b, chars_b) = cut(data, index, a, rule.unit), cut(data, index, b, rule.unit)
    if h4 % 100 < rule.spm:
        return index.n_units, "spm", chars_a, chars_b - chars_a, b"".join([s, data[b:], p, data[:a], m, data[a:b]])
    return index.n_units, "psm", chars_a, chars_b - chars_a, b"".join([p, data[:a], s, data[b:], m, data[a:b]])


def fill_in_middle(docs: DataFrame, rule: Rule = Rule(), text_col: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row."""
    rule.marks.check()
    if rule.unit not in ("line", "char"):
        raise ValueError(f"no such unit: {rule.unit}")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("data"))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rows = 0, []
            for doc_id, data in zip(batch.column(0), batch.column(1), strict=True):
                key = doc_id.as_py()
                rows.append((key, *transformed(key, data.as_py(), rule)))
                size += len(rows[-1][-1])
                if size >= 1 << 20:  # outputs wait in chunks of about 1 MB, or of one text
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    size, rows = 0, []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
    return own.mapInArrow(run, schema).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, marks: Sentinels = Sentinels()) -> Column:
    """The text that an output was made of; sentinels stand once in it."""

    def between(first: str, then: str, last: str) -> tuple[Column, Column, Column]:
        head = F.substring_index(output, then, 1)
        head = head.substr(F.lit(len(first) + 1), F.length(head))
        rest = F.substring_index(F.substring_index(output, last, 1), then, -1)
        return head, rest, F.substring_index(output, last, -1)

    p, s, m = marks
    prefix, suffix, middle = between(p, s, m)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = between(s, p, m)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)


def op11_query(spark, sf_dir: str) -> DataFrame:
    found = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(text.cast("binary"), 256).alias("restored_sha256"))
