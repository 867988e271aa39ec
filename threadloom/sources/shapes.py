"""The shape of many archives as one lattice of types.

Every document is walked where it lies and gives, for each place in it, the kinds
of values that stand there. Places are merged by sums, so neither the order of
files nor how they are dealt matters, and joined kind by kind: null gives way to
any kind, whole numbers to numbers, and what has no kind in common is a conflict
whose counts are kept.

Defined results: a document that is no JSON counts as ``invalid`` at the root; a
null document as ``null``; of repeated keys the last counts; documents of any size are
walked whole, one at a time; empty tables have no places.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Places that a task counts before it hands them on.
HELD = 50_000
_PLAIN = re.compile(r"[A-Za-z_][\w-]*\Z")
_KINDS = {bool: "boolean", int: "integer", float: "number", str: "string", type(None): "null", dict: "object", list: "array"}


def places(value) -> Counter:
    """``(place, parent, kind)`` of everything in a value, with counts."""
    out: Counter = Counter()
    open_ = [("$", "", value)]
    while open_:
        place, parent, x = open_.pop()
        out[place, parent, _KINDS[type(x)]] += 1
        if isinstance(x, dict):
            open_ += [(f"{place}.{k}" if _PLAIN.match(k) else f"{place}[{json.dumps(k)}]", place, v) for k, v in x.items()]
        elif isinstance(x, list):
            open_ += [(f"{place}[]", place, v) for v in x]
    return out


def _parsed(raw: str | None) -> Counter:
    try:
        return places(None if raw is None else json.loads(raw))
    except (ValueError, RecursionError):
        return Counter({("$", "", "invalid"): 1})


def shapes(documents: DataFrame, column: str = "raw") -> DataFrame:
    """``place, kind, kinds, n, documents, optional, conflict`` of all documents.

    ``kinds`` has the count of each kind; ``optional`` marks fields that some
    objects at their place lack; ``kind`` is null where the kinds conflict.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        seen: Counter = Counter()

        def batch() -> pa.RecordBatch:
            rows = [(*key, n, seen[key]) for key, n in held.items()]
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["place", "parent", "kind", "n", "documents"])

        for part in batches:
            for raw in part.column(0):
                found = _parsed(raw.as_py())
                held.update(found)
                seen.update(found.keys())
                if len(held) >= HELD:
                    yield batch()
                    held.clear()
                    seen.clear()
        if held:
            yield batch()

    each = documents.select(F.col(f"`{column}`").cast("string").alias("raw")).mapInArrow(run, "place string, parent string, kind string, n long, documents long")
    summed = each.groupBy("place", "parent", "kind").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    listed = F.array_sort(F.collect_list(F.struct("kind", "n")))  # seven kinds at most
    joined = summed.groupBy("place", "parent").agg(F.map_from_entries(listed).alias("kinds"), F.sum("n").alias("n"), F.max("documents").alias("documents"))
    real = F.array_remove(F.map_keys("kinds"), "null")
    numbers = F.array(F.lit("integer"), F.lit("number"))
    kind = F.when(F.size(real) == 0, "null").when(F.size(F.array_except(real, numbers)) == 0, F.when(F.array_contains(real, "number"), "number").otherwise("integer")).when(F.size(real) == 1, F.get(real, 0))
    objects = summed.where("kind = 'object'").select(F.col("place").alias("parent"), F.col("n").alias("objects"))
    out = joined.withColumn("kind", kind).join(objects, "parent", "left")
    field = ~F.col("place").endswith("[]") & F.col("objects").isNotNull()
    return out.select("place", "kind", "kinds", "n", "documents", F.coalesce(field & (F.col("n") < F.col("objects")), F.lit(False)).alias("optional"), F.col("kind").isNull().alias("conflict"))
