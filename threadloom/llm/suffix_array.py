"""Distributed difference-cover suffix array (DC3), literally.

Sort the triples at positions 1 and 2 modulo 3, name them by rank, recurse on
the string of names unless all differ, sort the suffixes at positions 0 modulo
3 by their first symbol and the rank of the next, and merge. Merging needs no
comparator: suffixes of class 0 are sorted once together with those of class 1
and once with those of class 2, by keys that make the two comparable, and the
counts of what stands before give the final place.

Every sort is a range partitioning of rows; indices come from the partitions'
sizes, which are all that reaches the driver. Each step is a written table.

``repeats.remove_repeats`` says why the corpus query samples by content
instead; tests hold the two to the same spans.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import written

_SHIFT = 33  # of the partition number in monotonically_increasing_id


def ordered(df: DataFrame, keys: list[str], flag: str | None = None) -> DataFrame:
    """Adds ``idx``, the place in the order of ``keys``, and ``before``: how
    many rows with ``flag`` (0 or 1) stand before.

    Rows of equal keys stay in one partition and get neighbouring places.
    """
    cols = df.columns
    sorted_ = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    sorted_ = sorted_.withColumn("mid", F.monotonically_increasing_id())
    if flag:
        schema = T.StructType([*sorted_.schema.fields, T.StructField("local", T.LongType())])

        def count(batches):
            seen = 0
            for b in batches:
                f = b.column(b.schema.get_field_index(flag)).to_numpy(zero_copy_only=False)
                run = f.cumsum() - f + seen
                seen += int(f.sum())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(run, pa.int64())], names=[*b.schema.names, "local"])

        sorted_ = sorted_.mapInArrow(count, schema)
    else:
        sorted_ = sorted_.withColumn("local", F.lit(0).cast("long"))
    rows = written(sorted_, "sa-sorted")
    flagged = F.sum(F.col(flag).cast("long")) if flag else F.lit(0).cast("long")
    parts = rows.groupBy(F.shiftright("mid", _SHIFT).alias("p")).agg(F.count("*"), flagged).orderBy("p").collect()  # one row a partition
    starts, before, n, m = {}, {}, 0, 0
    for p, rows_in, flags_in in parts:
        starts[p], before[p] = n, m
        n, m = n + rows_in, m + (flags_in or 0)
    at = lambda d: F.element_at(F.from_json(F.lit("{" + ",".join(f'"{p}":{v}' for p, v in d.items()) + "}"), "map<string,bigint>"), F.shiftright("mid", _SHIFT).cast("string"))
    idx = at(starts) + F.col("mid").bitwiseAND((1 << _SHIFT) - 1)
    return rows.select(*cols, idx.alias("idx"), (at(before) + F.col("local")).alias("before"))


def _spread(df: DataFrame, value: str, ahead: tuple[int, ...], names: tuple[str, ...]) -> DataFrame:
    """``pos`` with the values of the positions ``ahead`` of it; 0 past the end."""
    parts = None
    for a, name in zip(ahead, names, strict=True):
        part = df.select((F.col("pos") - a).alias("pos"), *[(F.col(value) if n == name else F.lit(None).cast("long")).alias(n) for n in names])
        parts = part if parts is None else parts.union(part)
    return parts.where("pos >= 0").groupBy("pos").agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in names])


def suffix_ranks(text: DataFrame, n: int, level: int = 0) -> DataFrame:
    """``pos, rank`` of all suffixes of ``text (pos, sym)``.

    Positions are 0 to n-1 without gaps, symbols are positive.
    """
    if n == 1:
        return text.select("pos", F.lit(0).cast("long").alias("rank"))
    n0, n2 = (n + 2) // 3, n // 3
    dummy = n % 3 == 1  # class 1 gets a last triple of nothing
    triples = _spread(text, "sym", (0, 1, 2), ("s0", "s1", "s2"))
    if dummy:
        triples = triples.union(text.sparkSession.range(1).select(F.lit(n).cast("long").alias("pos"), *[F.lit(0).cast("long").alias(c) for c in ("s0", "s1", "s2")]))
    triples = written(triples, f"sa-triples-{level}")
    sample = triples.where("pos % 3 <> 0")
    kinds = ordered(sample.select("s0", "s1", "s2").distinct(), ["s0", "s1", "s2"]).select("s0", "s1", "s2", (F.col("idx") + 1).alias("name"))
    named = written(sample.join(kinds, ["s0", "s1", "s2"]).select("pos", "name"), f"sa-names-{level}")
    m = n0 + n2
    if named.agg(F.count_distinct("name")).first()[0] < m:
        third = F.floor(F.col("pos") / 3).cast("long")
        shorter = named.select(F.when(F.col("pos") % 3 == 1, third).otherwise(third + n0).alias("pos"), F.col("name").alias("sym"))
        inner = suffix_ranks(shorter, m, level + 1)
        place = F.col("pos")
        ranks = inner.select(F.when(place < n0, place * 3 + 1).otherwise((place - n0) * 3 + 2).alias("pos"), (F.col("rank") + 1).alias("r"))
    else:
        ranks = named.select("pos", F.col("name").alias("r"))
    ranks = written(ranks, f"sa-ranks-{level}")
    nexts = _spread(ranks, "r", (0, 1, 2), ("r0", "r1", "r2"))
    every = written(triples.join(nexts, "pos", "left").where(F.col("pos") < n).select("pos", "s0", "s1", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("r0", "r1", "r2")], (F.col("pos") % 3).alias("k")), f"sa-every-{level}")
    zero = (F.col("k") == 0).cast("long").alias("zero")
    one = ordered(every.where("k <> 2").select("pos", "k", "s0", "r1", "r0", zero), ["s0", "r1"], "zero")
    two = ordered(every.where("k <> 1").select("pos", "k", "s0", "s1", "r2", "r0", zero), ["s0", "s1", "r2"], "zero")
    # samples: their own rank, without the dummy, and the zeros before them
    own = F.col("r0") - 1 - int(dummy)
    samples = one.where("k = 1").select("pos", (own + F.col("before")).alias("rank")).union(two.where("k = 2").select("pos", (own + F.col("before")).alias("rank")))
    # zeros: place among zeros is ``before`` itself; the rest before them are samples
    a = one.where("k = 0").select("pos", F.col("idx").alias("ia"), F.col("before").alias("b"))
    b = two.where("k = 0").select("pos", F.col("idx").alias("ib"))
    zeros = a.join(b, "pos").select("pos", (F.col("ia") + F.col("ib") - F.col("b")).alias("rank"))
    return written(samples.union(zeros), f"sa-level-{level}")


def corpus_symbols(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, int]:
    """``pos, sym, doc, at``: the bytes of all texts, each text closed by a
    symbol of its own, so that no suffix order looks past a document.

    Documents are numbered by the order of the rows' partitions.
    """
    lines = written(docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"), F.col("doc_id").cast("long").alias("doc_id")), "sa-docs")
    sized = ordered(lines.withColumn("key", F.xxhash64("t", "doc_id")), ["key", "doc_id", "t"]).select("t", "doc_id", F.col("idx").alias("doc"))
    sized = written(sized.withColumn("size", F.octet_length("t") + 1), "sa-sized")
    n_docs = sized.count()
    chunk = 4096  # documents a block: the blocks' sums are what reaches the driver
    blocks = sized.groupBy(F.floor(F.col("doc") / chunk).cast("long").alias("block")).agg(F.sum("size")).orderBy("block").collect()
    begin, n = {}, 0
    for b, size in blocks:
        begin[b] = n
        n += size
    start = F.element_at(F.from_json(F.lit("{" + ",".join(f'"{b}":{v}' for b, v in begin.items()) + "}"), "map<string,bigint>"), F.floor(F.col("doc") / chunk).cast("long").cast("string"))
    within = F.expr(f"sum(size) over (partition by floor(doc / {chunk}) order by doc rows between unbounded preceding and 1 preceding)")
    placed = sized.withColumn("base", start + F.coalesce(within, F.lit(0)))
    codes = F.transform(F.filter(F.split(F.hex(F.col("t").cast("binary")), "(?<=\\G..)"), lambda h: h != ""), lambda h: F.conv(h, 16, 10).cast("long") + n_docs + 1)
    whole = F.concat(codes, F.array(F.col("doc") + 1))
    rows = placed.select("doc", "doc_id", "base", F.posexplode(whole).alias("at", "sym"))
    return written(rows.select((F.col("base") + F.col("at")).alias("pos"), "sym", "doc", "doc_id", F.col("at").cast("long").alias("at")), "sa-symbols"), n


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """``doc, doc_id, at``: starts of windows that stand anywhere else.

    Neighbours in the suffix order are compared over ``length`` bytes: a window
    is repeated if it equals that of the suffix before or after. Windows that
    reach past their document hold its closing symbol and equal none.
    """
    symbols, n = corpus_symbols(docs)
    if n == 0:
        return symbols.select("doc", "doc_id", "at")
    ranks = suffix_ranks(symbols.select("pos", "sym"), n)
    names = _prefix_names(symbols.select("pos", "sym"), length)
    placed = written(ranks.join(names, "pos"), "sa-placed")
    after = placed.select((F.col("rank") - 1).alias("rank"), F.col("name").alias("next"), F.col("pos").alias("pos2"))
    equal = placed.join(after, "rank").where("name = next")
    both = equal.select("pos").union(equal.select(F.col("pos2").alias("pos"))).distinct()
    return symbols.join(both, "pos").select("doc", "doc_id", "at")


def _prefix_names(text: DataFrame, length: int) -> DataFrame:
    """``pos, name``: equal for equal strings of ``length`` symbols, by doubling."""
    have, names = 1, written(text.select("pos", F.col("sym").alias("name")), "sa-prefix")
    while have < length:
        step = min(have, length - have)
        pair = _spread(names, "name", (0, step), ("a", "b"))
        kinds = ordered(pair.select("a", "b").distinct(), ["a", "b"]).select("a", "b", (F.col("idx") + 1).alias("name"))
        names = written(pair.join(kinds, ["a", "b"]).select("pos", "name"), "sa-prefix")
        have += step
    return names
