"""The metadata at the end of archives, by range reads.

Spark lists the files; a task opens each and reads its last block only, doubling
it while the metadata begins before it. A document's end is outside of every
string and bracket, so from there quotes and brackets are counted backwards: the
key that stands outside strings with one bracket open is the document's own.

Defined results: null metadata where the document ends in anything but an object,
has no such key, or has it more than ``most`` bytes before its end; of several
keys the last counts; files of any size are read by at most ``most`` bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 1 << 14
MOST = 1 << 20
_KEY = re.compile(rb'"_metadata"\s*:')
_ESCAPE = re.compile(rb"\\.", re.S)


def metadata_of(tail: bytes, whole: bool) -> bytes | None:
    """The raw value of the document's ``_metadata``, from its last bytes."""
    end = len(tail.rstrip(b" \t\r\n"))
    if not end or tail[end - 1] != 125:
        return None
    first = 0
    if not whole:  # a run of backslashes at the border cannot be read
        first = len(tail) - len(tail.lstrip(b"\\")) + 1
    flat = np.frombuffer(b"_" * first + _ESCAPE.sub(b"__", tail[first:end]), np.uint8)
    quote = flat == 34
    outside = (np.cumsum(quote[::-1])[::-1] & 1) == 0  # an even number of quotes from here on
    step = (np.isin(flat, (125, 93)).astype(np.int64) - np.isin(flat, (123, 91))) * outside
    depth = np.cumsum(step[::-1])[::-1]  # brackets open at each place
    for m in reversed(list(_KEY.finditer(tail, first, end))):
        at = m.start()
        if quote[at] and outside[at] and depth[at] == 1:
            begin = m.end()
            ends = np.flatnonzero((depth[begin:] == 1) & (step[begin:] == 0) & (flat[begin:] == 44) & outside[begin:])  # a comma of the document
            stop = begin + int(ends[0]) if len(ends) else end - 1
            return tail[begin:stop].strip()
    return None


def read_tail(open_file, size: int, block: int = BLOCK, most: int = MOST) -> tuple[bytes | None, int]:
    """Metadata and bytes read; ``open_file`` gives a file that can seek."""
    with open_file() as f:
        tail = b""
        while True:
            take = min(size, most, max(block, 2 * len(tail)))
            f.seek(size - take)
            tail = f.read(take - len(tail)) + tail
            found = metadata_of(tail, take == size)
            if found is not None or take >= min(size, most):
                return found, len(tail)


def archive_tails(spark: SparkSession, path: str, glob: str = "*_archive.json", block: int = BLOCK, most: int = MOST) -> DataFrame:
    """``path, archive_file, file_size, bytes_read, metadata`` of every file under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            rows = []
            for name, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", name))
                found, n = read_tail(lambda s=store, p=inner: s.open_input_file(p), size, block, most)
                rows.append((name, size, n, found))
            if rows:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["path", "file_size", "bytes_read", "raw"])

    found = files.mapInArrow(run, "path string, file_size long, bytes_read long, raw binary")
    text = F.get_json_object(F.concat(F.lit('{"m":'), F.col("raw").cast("string"), F.lit("}")), "$.m")
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("archive_file"), "file_size", "bytes_read", text.alias("metadata"))
