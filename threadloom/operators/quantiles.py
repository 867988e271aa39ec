"""Exact quantiles without holding the values.

Each round counts the values between two bounds in a fixed number of bins, and
goes on with the bin that the rank falls into, between the least and the greatest
value that it really has. Bins hold equally many doubles, not equal ranges, so any
distribution is divided by the number of bins in a round, and 64 bits take six
rounds. Once a bin holds few values or can hold but few, they are looked at. So no
aggregate holds more than the bins, however many distinct values there are.

Defined results: nulls and not-a-numbers are left out; without other values every
quantile is null; infinite values stand for the greatest and least finite ones;
between two ranks the quantile is interpolated; repeated values count each; whole
numbers beyond 2**53 are rounded to doubles.
"""

from __future__ import annotations

import math
import struct
import sys
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.durable import written

BINS = 4096
#: Distinct values that are looked at on the driver.
FEW = 4096
_MOST = sys.float_info.max


def values_of(df: DataFrame, column: str) -> DataFrame:
    """The finite values of a column, written."""
    x = F.col(f"`{column}`").cast("double") + F.lit(0.0)  # no negative zero
    return written(df.select(F.greatest(F.lit(-_MOST), F.least(F.lit(_MOST), x)).alias("x")).where(x.isNotNull() & ~F.isnan(x)), "quantile-values")


def _bits(x: float) -> int:
    """Doubles in their order as whole numbers, neighbours next to each other."""
    i = struct.unpack("<q", struct.pack("<d", x))[0]
    return i if i >= 0 else -(i & sys.maxsize)


def _double(i: int) -> float:
    return math.copysign(struct.unpack("<d", struct.pack("<q", abs(i)))[0], i)


def select(values: DataFrame, ranks: Sequence[int], bins: int = BINS, few: int = FEW) -> dict[int, float]:
    """The value of each rank, from 0, of ``values (x)``."""
    found: dict[int, float] = {}
    lo, hi, n = values.agg(F.min("x"), F.max("x"), F.count("*")).first()
    cells = {r: (lo, hi, 0, n) for r in ranks if 0 <= r < n}  # least, greatest, values before, values within
    while cells:
        for cell in set(cells.values()):
            lo, hi, before, n = cell
            mine = [r for r, c in cells.items() if c == cell]
            inside = values.where((F.col("x") >= lo) & (F.col("x") <= hi))
            if lo == hi:
                found |= {r: lo for r in mine}
                for r in mine:
                    del cells[r]
                continue
            first_bits, last_bits = _bits(lo), _bits(hi)
            if n <= few or last_bits - first_bits < bins:  # so many rows at most
                rows = sorted((r["x"], r["n"]) for r in inside.groupBy("x").agg(F.count("*").alias("n")).collect())
            else:
                edges = [_double(first_bits + (last_bits - first_bits) * k // bins) for k in range(bins + 1)]
                dealt = Bucketizer(splits=edges, inputCol="x", outputCol="at").transform(inside)
                rows = sorted((r["lo"], r["n"], r["hi"]) for r in dealt.groupBy("at").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n")).collect())  # a row a bin
            for r in mine:
                upto = before
                for first, count, *last in rows:
                    if r < upto + count:
                        break
                    upto += count
                if last and last[0] != first:
                    cells[r] = (first, last[0], upto, count)
                else:
                    found[r] = first
                    del cells[r]
    return found


def quantiles(df: DataFrame, column: str, shares: Sequence[float], **options) -> list[float | None]:
    """The quantiles of a column, interpolated between ranks."""
    values = values_of(df, column)
    n = values.count()
    if not n:
        return [None] * len(shares)
    places = [s * (n - 1) for s in shares]
    at = select(values, sorted({k for p in places for k in (math.floor(p), math.ceil(p))}), **options)
    return [at[math.floor(p)] + (at[math.ceil(p)] - at[math.floor(p)]) * (p - math.floor(p)) for p in places]
