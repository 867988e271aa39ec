"""Mixing sources to target weights by entropy balancing (operator 12).

Sources get targets in words, by weight, where none may exceed ``most`` times
its own size. Documents then get rates (expected copies) that meet the targets
and otherwise stay as near to one copy each as they can, by relative entropy.
The rates that do so are exponentially tilted by size, ``exp(l * size)``, up to
``most``; the ``l`` of each source solves a convex dual, whose slope is the words
that the rates take less the target. Newton steps on its logarithm find it, for
all sources at once, held between bounds that earlier steps have found.

Rates depend on source and size alone, so the steps run over a table of cells
(source, size, rows), not over documents. A cell's expected copies are rounded
along the source's cells from long to short, carrying the remainder on, so a
source misses its target by half of its longest document at most; what it misses
is then made good, a few times, by one copy more or less of the size nearest to
it. In a cell rows have equally many copies, and the first by digest one more.

All is built-in functions. The driver sees counts and two numbers a round, never a
source or a cell. Sums are decimal, so that reruns agree to the last digit.
A hot source is some thousand cells, and cumulative sums go over bands of sizes;
a hot cell is numbered by ranges of digests, and so are equal rows, which lie in
one digest, by their number among them.

Defined results: a null or empty text has size 0 and takes nothing; a null
source is one source, the last; a null ``doc_id`` is one like any other; rows
with equal ``doc_id`` and text are equal, and which of them has a copy more is not
defined, only how many; a source without words has target 0; where targets
cannot be met since all are at their bound, all rates are ``most``; texts of any
length are read whole; other columns come along in ``record``, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from threadloom.llm.common import BROADCAST_ROWS, ranked, written

WEIGHTS = (1.0, 2.0, 3.0)
PERCENT = 100.0
MOST = 3
#: Newton rounds at most; some ten are usual, and halving alone needs fewer than this.
ROUNDS = 200
#: Times that a source's miss is made good by one copy.
MENDED = 2
#: A source's words are met when this near, as a share or in words.
NEAR, NEAR_WORDS = 1e-9, 0.25
#: Rows that one task numbers at once, about.
RANGE_ROWS = 4096
_SPACE = r" \t\n\x0B\f\r"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, without a list of them."""
    ended = F.rtrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(" \t\n\x0b\f\r"))  # a regex would try every blank of a run
    return F.length(F.regexp_replace(ended, rf"[{_SPACE}]*+[^{_SPACE}]++", "x")).cast("long")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, percent: float = PERCENT, most: int = MOST) -> DataFrame:
    """``sources (source, size, ...)`` with ``sid``, ``weight``, ``target`` and ``full``.

    What sources at their bound leave over goes to the others by weight, in
    rounds until none is above; ``full`` marks those at their bound.
    """
    numbered = ranked(sources, [F.col("source").isNull().asc(), F.asc("source")], "sid", "mix-sources")
    held = written(numbered.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))), "mix-weights")
    bound = F.col("size") * F.lit(float(most))
    total = float(held.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]) * percent / 100
    unit, seen = 0.0, -1  # words a weight; grows as sources leave
    while True:
        full = bound <= F.col("weight") * F.lit(unit)
        n, words, rest = held.agg(F.count_if(full), F.sum(F.when(full, bound.cast("decimal(38,6)"))), F.sum(F.when(~full, F.col("weight").cast("decimal(38,9)")))).first()
        if n == seen or not rest:
            break
        seen, unit = n, (total - float(words or 0)) / float(rest)
    return held.withColumn("full", full).withColumn("target", F.when(full, bound).otherwise(F.col("weight") * F.lit(unit)))


def rate(most: int = MOST) -> Column:
    """Copies of a row of ``size`` at tilt ``l``."""
    return F.when(F.col("full"), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.exp(F.col("l") * F.col("size") / F.col("mean"))))


def tilts(cells: DataFrame, sources: DataFrame, most: int = MOST, of_source=lambda x: x) -> DataFrame:
    """``sources`` with ``l``, for which the rates of their cells take their targets."""
    state = sources.withColumn("l", F.lit(0.0)).withColumn("lo", F.lit(None).cast("double")).withColumn("hi", F.lit(None).cast("double")).withColumn("met", F.col("full") | (F.col("target") <= 0))
    exact = lambda x: F.sum(x.cast("decimal(38,6)")).cast("double")
    c = F.col
    taken = c("n") * c("size") * c("rate")
    for _ in range(ROUNDS):
        now = cells.join(of_source(state.where("not met").select("sid", "l", "mean", "full")), "sid").withColumn("rate", rate(most))
        sums = now.groupBy("sid").agg(exact(taken).alias("f"), exact(F.when(c("rate") < most, taken * c("size") / c("mean"))).alias("slope"))
        lo, hi = F.when(c("f") < c("target"), c("l")).otherwise(c("lo")), F.when(c("f") > c("target"), c("l")).otherwise(c("hi"))
        step = c("l") + (F.log(c("target")) - F.log(F.when(c("f") > 0, c("f")))) * c("f") / F.when(c("slope") > 0, c("slope"))
        wide = lambda x: F.greatest(F.lit(1.0), F.abs(x) * 2)
        halved = F.when(c("lo2").isNull(), c("hi2") - wide(c("hi2"))).when(c("hi2").isNull(), c("lo2") + wide(c("lo2"))).otherwise((c("lo2") + c("hi2")) / 2)
        inside = c("step").isNotNull() & (c("lo2").isNull() | (c("step") > c("lo2"))) & (c("hi2").isNull() | (c("step") < c("hi2")))
        near = F.abs(c("f") - c("target")) <= F.greatest(F.lit(NEAR_WORDS), c("target") * NEAR)
        tried = state.join(sums, "sid", "left").withColumn("lo2", lo).withColumn("hi2", hi).withColumn("step", step)
        stuck = c("lo2").isNotNull() & c("hi2").isNotNull() & ((halved <= c("lo2")) | (halved >= c("hi2")))
        done = c("met") | near | stuck
        new = tried.select(*[c(x) for x in sources.columns], F.when(done, c("l")).when(inside, c("step")).otherwise(halved).alias("l"), c("lo2").alias("lo"), c("hi2").alias("hi"), done.alias("met"))
        watch = Observation()
        state = written(new.observe(watch, F.count_if(~c("met")).alias("open")), "mix-tilts")
        if not watch.get["open"]:
            break
    return state.drop("lo", "hi", "met")


def cell_copies(cells: DataFrame, most: int = MOST, of_source=lambda x: x) -> DataFrame:
    """``cells`` with ``base`` copies of each row and ``extra`` rows with one more."""
    c = F.col
    due = cells.select("sid", "size", "n", "target", "rate").withColumn("due", (c("n") * c("rate")).cast("decimal(38,9)")).withColumn("band", F.floor(F.log2(c("size") + 1) * 16).cast("int"))
    bands = due.groupBy("sid", "band").agg(F.sum("due").cast("decimal(38,9)").alias("band_due"))
    before = bands.withColumn("before", F.expr("coalesce(sum(band_due) over (partition by sid order by band desc rows between unbounded preceding and 1 preceding), 0)").cast("decimal(38,9)"))
    run = F.expr("sum(due) over (partition by sid, band order by size desc rows between unbounded preceding and current row)").cast("decimal(38,9)")
    upto = due.join(before.drop("band_due"), ["sid", "band"]).withColumn("upto", (run + c("before")).cast("decimal(38,9)"))
    copies = (F.round("upto").cast("decimal(38,0)") - F.round((c("upto") - c("due")).cast("decimal(38,9)")).cast("decimal(38,0)")).cast("long")
    out = written(upto.withColumn("copies", copies).select(*cells.columns, "copies"), "mix-rounded")
    for _ in range(MENDED):
        out = written(_mended(out, most, of_source), "mix-mended")
    return out.withColumn("base", F.expr("copies div n")).withColumn("extra", c("copies") - F.expr("copies div n") * c("n"))


def _mended(cells: DataFrame, most: int, of_source) -> DataFrame:
    """``cells`` with one copy more or less where that brings a source nearer its target."""
    c = F.col
    miss = cells.groupBy("sid").agg((F.first("target") - F.sum(c("copies") * c("size"))).alias("miss"))
    left = F.abs(F.abs("miss") - c("size"))
    free = F.when(c("miss") > 0, c("copies") < most * c("n")).otherwise(c("copies") > 0)
    tried = cells.select("sid", "size", "n", "copies").join(of_source(miss), "sid").where(free & (left < F.abs("miss")))
    best = tried.groupBy("sid").agg(F.min_by("size", F.struct(left, "size")).alias("best"), F.first("miss").alias("miss"))
    more = F.when(c("size") == c("best"), F.signum("miss").cast("long")).otherwise(F.lit(0))
    return cells.join(of_source(best), "sid", "left").withColumn("copies", c("copies") + F.coalesce(more, F.lit(0))).select(*cells.columns)


def _range(digest: str, n: Column) -> Column:
    """Number of the range, of ``RANGE_ROWS`` rows on average, that a digest falls into."""
    return ((F.shiftrightunsigned(F.col(digest), 33) * F.ceil(n / RANGE_ROWS)) / F.lit(1 << 31)).cast("long")


def dealt(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """``groups (sid, size, digest, m)`` with the cell's ``base`` and their ``extra`` rows."""
    c = F.col
    both = groups.join(cells.select("sid", "size", "n", "base", "extra"), ["sid", "size"])
    some = written(both.where("extra > 0").withColumn("part", _range("digest", c("n"))), "mix-open")
    parts = some.groupBy("sid", "size", "part").agg(F.sum("m").alias("rows"))
    before = parts.withColumn("before", F.expr("coalesce(sum(rows) over (partition by sid, size order by part rows between unbounded preceding and 1 preceding), 0)")).drop("rows")
    run = F.expr("sum(m) over (partition by sid, size, part order by digest rows between unbounded preceding and current row)")
    placed = some.withColumn("run", run).join(before, ["sid", "size", "part"])
    own = F.greatest(F.lit(0), F.least(c("m"), c("extra") - c("before") - c("run") + c("m")))
    return both.where("extra = 0").select("sid", "size", "digest", "m", "base", "extra").unionByName(placed.select("sid", "size", "digest", "m", "base", own.alias("extra")))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``place``: each one's number among the rows of its digest, from 1."""
    held = written(rows.withColumn("row", F.xxhash64(F.monotonically_increasing_id())), "mix-partial").withColumn("part", _range("row", F.col("m")))
    keys = ["sid", "size", "digest"]
    before = held.groupBy(*keys, "part").agg(F.count("*").alias("rows"))
    before = before.withColumn("before", F.expr("coalesce(sum(rows) over (partition by sid, size, digest order by part rows between unbounded preceding and 1 preceding), 0)")).drop("rows")
    at = F.expr("row_number() over (partition by sid, size, digest, part order by row)")
    return held.withColumn("at", at).join(before, [*keys, "part"]).withColumn("place", F.col("at") + F.col("before")).drop("at", "part", "before", "row")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, percent: float = PERCENT, most: int = MOST, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, record`` of every row.

    ``record`` is the row itself; ``repeated`` writes the copies out.
    """
    c = F.col
    doc_id, text = c("doc_id").cast("long"), c(f"`{text_col}`").cast("string")
    rows = docs.select(
        F.struct(*[c(f"`{x}`") for x in docs.columns]).alias("record"), doc_id.alias("doc_id"), c(f"`{source_col}`").cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64(doc_id, text).alias("digest")
    )
    groups = written(rows.groupBy("source", "size", "digest").agg(F.count("*").alias("m")), "mix-groups")
    counted = written(groups.groupBy("source", "size").agg(F.sum("m").alias("n")), "mix-cells")
    sums = written(counted.groupBy("source").agg(F.sum(c("size") * c("n")).alias("size"), F.sum("n").alias("rows")), "mix-sums")
    sources = targets(sums, weights, percent, most).withColumn("mean", F.greatest(F.lit(1.0), c("size") / c("rows")))
    sources = written(sources.select("source", "sid", c("size").alias("source_size"), "target", "full", "mean"), "mix-targets")
    few = sources.count() <= BROADCAST_ROWS
    of_source = F.broadcast if few else lambda x: x  # for tables of a row a source
    key = sources.select(c("source").alias("name"), "sid")
    with_sid = lambda df, tag: (lambda x: x if few else written(x, tag))(df.join(of_source(key), c("source").eqNullSafe(c("name"))).drop("source", "name"))
    cells = with_sid(counted, "mix-cells")
    state = tilts(cells, sources, most, of_source)
    rated = cells.join(of_source(state.select("sid", "target", "mean", "full", "l")), "sid").withColumn("rate", rate(most))
    found = written(cell_copies(rated.select("sid", "size", "n", "target", "rate"), most, of_source), "mix-copies")
    own = dealt(with_sid(groups, "mix-groups"), found)
    said = written(own.join(of_source(state), "sid").withColumn("rate", rate(most)).drop("mean", "full", "l"), "mix-dealt")
    said = said.withColumnsRenamed({"source": "name", "size": "words", "digest": "mark"})
    same = c("source").eqNullSafe(c("name")) & (c("size") == c("words")) & (c("digest") == c("mark"))
    out = ["doc_id", "source", "size", "source_size", "target", "rate", "copies", "record"]
    split = said.where("extra > 0 and extra < m")  # of each cell one group at most, of equal rows
    if split.isEmpty():
        return rows.join(said, same).withColumn("copies", c("base") + (c("extra") > 0).cast("long")).select(*out)
    whole = rows.join(said.where("extra = 0 or extra = m"), same).withColumn("copies", c("base") + (c("extra") > 0).cast("long"))
    partly = _numbered(rows.join(split, same).drop("name", "words", "mark")).withColumn("copies", c("base") + (c("place") <= c("extra")).cast("long"))
    return whole.select(*out).unionByName(partly.select(*out))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mixed corpus: each record as often as it has copies."""
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("record.*")


def op12_query(spark, sf_dir: str) -> DataFrame:
    found = mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
