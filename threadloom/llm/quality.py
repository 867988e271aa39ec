"""Quality rules as learned decision lists (operator 6).

One narrow pass turns each whole text into statistics. A bounded sample of
labelled rows (``LABEL_ROWS``, taken by hash order) teaches a decision list by
sequential covering: a rule is grown as a conjunction of thresholds on half of
the data still uncovered, pruned on the other half, and kept while it is
precise. The list is emitted as ordered Spark conditional expressions
(``CASE WHEN ... THEN ...``), so its use on the corpus is a projection.

Defined results: a null text is an empty one; documents without label are only
judged; labels that disagree on a document count as its worst; labels without
document are passed over; with no labels, or labels of one kind, the list is
empty and all that passes the base rules is kept; a null ``doc_id`` is judged
and never labelled; repeated rows are judged each; texts of any length are taken
whole; ties between conditions go to the first feature and lowest threshold;
other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import map_rows, text_mark, without_rows, written

#: Labelled rows that the list is fitted on, at most.
LABEL_ROWS = 50_000
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\v\f\r"
#: What a learned condition may test, all of it comparable across lengths.
FEATURES = (
    "symbols_per_word", "repeat_share", "dup_line_share", "upper_share", "digit_share",
    "mean_word", "bang_share", "pipe_share", "distinct_share", "n_words",
)


class Stats(NamedTuple):
    doc_id: int | None
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    symbols_per_word: float
    repeat_share: float
    dup_line_share: float
    upper_share: float
    digit_share: float
    mean_word: float
    bang_share: float
    pipe_share: float
    distinct_share: float


def statistics_of(doc_id: int | None, text: str | None) -> Stats:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    again = len(lines) - len(set(lines))
    repeated, end = 0, 0
    if n > 2:
        seen = Counter(zip(words, words[1:], words[2:], strict=False))
        if len(seen) < n - 2:
            for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)):
                if seen[w] > 1:
                    repeated += i + 3 - max(i, end)
                    end = i + 3
    per, per_char = max(n, 1), max(chars, 1)
    upper = sum(1 for w in words if w.isupper())
    digits = sum(map(text.count, "0123456789"))
    return Stats(
        doc_id, n, chars, symbols, again, repeated, symbols / per, repeated / per, again / max(len(lines), 1),
        upper / per, digits / per_char, chars / per, text.count("!") / per, text.count("|") / per, len(set(words)) / per,
    )


SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(c, T.LongType()) for c in Stats._fields[1:6]]
    + [T.StructField(c, T.DoubleType()) for c in Stats._fields[6:]]
)


def document_statistics(docs: DataFrame, text_col: str = "text", marks: bool = False) -> DataFrame:
    """Statistics of every row; with ``marks`` the text's mark goes along."""

    def make():
        return lambda rows: [(*statistics_of(*r[:2]), *r[2:]) for r in rows]

    text = F.col(f"`{text_col}`").cast("string")
    more = [text_mark(text).alias("mark")] if marks else []
    schema = T.StructType(SCHEMA.fields + [T.StructField("mark", T.StringType()) for _ in more])
    return map_rows(docs.select(F.col("doc_id").cast("long"), text.alias("text"), *more), make, schema, weigh=1)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def mask(self, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
        v = x[:, names.index(self.feature)]
        return v >= self.threshold if self.above else v <= self.threshold

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    keep: bool
    precision: float
    covered: int

    def __str__(self) -> str:
        return f"{' and '.join(map(str, self.conditions))} -> {'keep' if self.keep else 'reject'} ({self.precision:.3f} of {self.covered})"


def _covered(conditions, x, names):
    m = np.ones(len(x), bool)
    for c in conditions:
        m &= c.mask(x, names)
    return m


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds halfway between neighbouring quantiles that differ."""
    q = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1), method="nearest"))
    return (q[1:] + q[:-1]) / 2


def _grow(x, bad, names, max_conditions, bins):
    """Adds the condition of the greatest information gain on bad rows."""
    conditions, on = [], np.ones(len(x), bool)
    while len(conditions) < max_conditions:
        p0, n0 = int((bad & on).sum()), int((~bad & on).sum())
        if n0 == 0 or p0 == 0:
            break
        best, gain0 = None, 1e-9
        prior = np.log2(p0 / (p0 + n0))
        for f, name in enumerate(names):
            v, b = x[on, f], bad[on]
            cuts = _cuts(v, bins)
            if not len(cuts):
                continue
            at = np.searchsorted(cuts, v, "left")  # v <= cuts[k] for k >= at
            pos = np.cumsum(np.bincount(at[b], minlength=len(cuts) + 1))[:-1]
            all_ = np.cumsum(np.bincount(at, minlength=len(cuts) + 1))[:-1]
            for above, p, a in ((False, pos, all_), (True, p0 - pos, p0 + n0 - all_)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where((p > 0) & (a > 0), p * (np.log2(p / a) - prior), -np.inf)
                k = int(np.argmax(gain))
                if gain[k] > gain0:
                    gain0, best = gain[k], Condition(name, above, float(cuts[k]))
        if best is None:
            break
        conditions.append(best)
        on &= best.mask(x, names)
    return conditions


def _worth(conditions, x, bad, names):
    m = _covered(conditions, x, names)
    p, n = int((bad & m).sum()), int((~bad & m).sum())
    return (p - n) / max(p + n, 1)


def learn(x: np.ndarray, bad: np.ndarray, names=FEATURES, min_precision=0.9, min_covered=8, max_rules=16, max_conditions=4, bins=64, seed=7) -> list[Rule]:
    """Rules that reject, most precise first found; what none covers is kept."""
    rng = np.random.default_rng(seed)
    left, rules = np.ones(len(x), bool), []
    while len(rules) < max_rules and (bad & left).sum() >= min_covered:
        at = np.flatnonzero(left)
        grow = rng.random(len(at)) < 2 / 3
        g, p = at[grow], at[~grow]
        conditions = _grow(x[g], bad[g], names, max_conditions, bins)
        best, worth = conditions, _worth(conditions, x[p], bad[p], names)
        for k in range(len(conditions) - 1, 0, -1):  # prune from the end
            if (w := _worth(conditions[:k], x[p], bad[p], names)) >= worth:
                best, worth = conditions[:k], w
        if not best:
            break
        m = _covered(best, x, names) & left
        n, precision = int(m.sum()), float(bad[m].mean()) if m.any() else 0.0
        if n < min_covered or precision < min_precision:
            break
        rules.append(Rule(tuple(best), False, precision, n))
        left &= ~m
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional expression: true is kept."""
    out = None
    for r in rules:
        cond = r.conditions[0].column()
        for c in r.conditions[1:]:
            cond = cond & c.column()
        out = F.when(cond, F.lit(r.keep)) if out is None else out.when(cond, F.lit(r.keep))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(stats: DataFrame, labels: DataFrame, label_rows: int = LABEL_ROWS, **options) -> list[Rule]:
    """Learns from at most ``label_rows`` labelled documents, by hash order.

    The one hash order is the bound's sample; any set of labels up to it is
    used whole.
    """
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")).where("quality is not null and doc_id is not null")
    few = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(label_rows)
    rows = stats.join(few, "doc_id").groupBy("doc_id", "quality").agg(*[F.max(c).alias(c) for c in FEATURES]).orderBy("doc_id").limit(label_rows).collect()
    if not rows:
        return []
    x = np.array([[float(r[c]) for c in FEATURES] for r in rows])
    bad = np.array([r["quality"] <= 0 for r in rows])
    return learn(x, bad, **options) if bad.any() and not bad.all() else []


def judge(docs: DataFrame, labels: DataFrame, text_col: str = "text", marks: bool = False, **options) -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` for every row of ``docs``."""
    stats = written(document_statistics(docs, text_col, marks), "quality")
    rules = fit(stats, labels, **options)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text the rules keep; columns unchanged.

    Each row goes by its own text, whatever other rows have its ``doc_id``.
    """
    judged = judge(docs, labels, marks=True, **options)
    return without_rows(docs, judged.where(~F.col("kept")).select("doc_id", "mark").distinct(), options.get("text_col", "text"))


def op6_query(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *FEATURES[:-1])
