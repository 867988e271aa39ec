"""Packing token sequences by best-fit decreasing (operator 8).

Documents become tokens where they lie; texts go no further. A document longer
than the window is first cut into full windows, each a sequence of its own that
goes through no group. What is left over is dealt by the number of its row into
groups of about ``group_rows`` pieces, whatever rows repeat, and in each group pieces go, longest first, into the open window that they
leave least room in, found by a segment tree over remaining capacities. Groups
are bounded, so a task's memory is; a group leaves at most a few windows badly
filled, which is nothing beside its thousands.

Tokens are those of the byte-level BPE vocabulary of the tokenizer file. Texts
of characters below U+0250 are encoded by ``tiktoken`` over the same vocabulary
(tests hold the two equal, character by character), three times faster; any
other text, and one with ``LONG_RUN`` characters in a row with or without white
space, on which the faster one may overflow its stack, by ``tokenizers`` itself.
Strings of special tokens in a text are ordinary text.

Defined results: a null text is empty and has the end token only; a null
``doc_id`` is packed like any other; repeated rows are packed each; texts of any
length are encoded whole, each by one task; of pieces of one length the smaller
``doc_id``, start and checksum is packed first; other columns are ignored, whatever
their names; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import map_rows, written

WINDOW = 1024
END = 0
#: Pieces that one task packs, on average.
GROUP_ROWS = 1 << 15
#: Characters in a row, all white space or none, that only ``tokenizers`` encodes.
LONG_RUN = 1000
_WIDE = re.compile("[^\x00-ɏ]")
_GAP = re.compile(rf"\s{{{LONG_RUN}}}")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """Byte-level BPE writes each byte as a printable character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _long_run(text: str) -> bool:
    """Whether ``LONG_RUN`` characters in a row are all white space, or none is."""
    words = text.split()
    lengths = list(map(len, words))
    if max(lengths, default=0) >= LONG_RUN:
        return True
    spare = len(text) - sum(lengths) - len(words) + 1  # white space beyond one between words
    return spare >= LONG_RUN - 1 and _GAP.search(text) is not None


class Encoder:
    """Text to token ids, for one tokenizer file."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]["vocab"]
        of = _byte_of()
        ranks = {bytes(of[c] for c in piece): i for piece, i in model.items() if all(c in of for c in piece) and not piece.startswith("<|")}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("same", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if _WIDE.search(text) or _long_run(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


def pieces(docs: DataFrame, window: int = WINDOW, text_col: str = "text", tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` and, if asked, ``ids``."""
    path = tokenizer or tokenizer_path()
    fields = [T.StructField(c, T.LongType()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids)

    def make():
        encoder = Encoder(path)

        def work(rows):
            out = []
            for doc, text in rows:
                ids = np.append(encoder.ids(text or ""), np.uint32(END)).astype("<u4")
                for at in range(0, len(ids), window):
                    part = ids[at : at + window]
                    row = (doc, at, len(part), zlib.crc32(part.tobytes()), len(ids))
                    out.append((*row, part.tolist()) if keep_ids else row)
            return out

        return work

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col(f"`{text_col}`").cast("string").alias("text")), make, schema, weigh=1)


class _Room:
    """Segment tree over remaining capacities 0..window: how many open windows."""

    def __init__(self, window: int):
        self.leaves = 1
        while self.leaves <= window:
            self.leaves *= 2
        self.tree = [0] * (2 * self.leaves)
        self.open: dict[int, list[int]] = defaultdict(list)

    def put(self, room: int, which: int) -> None:
        self.open[room].append(which)
        at = room + self.leaves
        while at:
            self.tree[at] += 1
            at >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The open window of the least room >= length, taken out."""
        at = length + self.leaves
        if not self.tree[at]:
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at *= 2
                if not self.tree[at]:
                    at += 1
        room = at - self.leaves
        while at:
            self.tree[at] -= 1
            at >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """(window number, offset there) of each length; lengths fall."""
    room, into, offsets, n = _Room(window), [], [], 0
    for length in lengths:
        found = room.take(length)
        if found is None:
            left, which, n = window, n, n + 1
        else:
            left, which = found
        into.append(which)
        offsets.append(window - left)
        if left > length:
            room.put(left - length, which)
    return into, offsets


def pack(docs: DataFrame, window: int = WINDOW, group_rows: int = GROUP_ROWS, **options) -> DataFrame:
    """Pieces of every document with ``sequence_id`` and ``offset``."""
    row = "__row"
    every = written(pieces(docs, window, **options).withColumn(row, F.monotonically_increasing_id()), "pieces")
    names = [c for c in every.columns if c != row]
    full = every.where(F.col("length") == window).select(*names, (F.col(row) + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = every.where(F.col("length") < window)
    n = max(1, -(-rest.count() // group_rows))
    dealt = rest.withColumn("g", F.pmod(F.xxhash64(row), F.lit(n)).cast("long")).drop(row)
    schema = T.StructType([*rest.drop(row).schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        into, offsets = best_fit_decreasing(pdf["length"].tolist(), window)
        first = int(pdf["g"].iloc[0]) << 32
        return pdf.drop(columns="g").assign(sequence_id=np.array(into, np.int64) + first, offset=np.array(offsets, np.int64))

    return dealt.groupBy("g").applyInPandas(fill, schema).unionByName(full)


def op8_query(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
