"""Column functions on ids, times and texts. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Milliseconds at which snowflake ids begin. Fixed value of the id format.
SNOWFLAKE_EPOCH = 1288834974657
#: Order in which versions of one post are preferred. Fixed values.
TYPE_PRIORITY = {"tweet": 1, "note_tweet": 2, "community_tweet": 3, "like": 4}


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_long(x: Column | str) -> Column:
    return F.expr("1") if x is None else c(x).try_cast("bigint")


def valid_id(x: Column | str) -> Column:
    """Decimal, at most 19 digits, and within 64 bits."""
    return c(x).rlike("^[0-9]{1,19}$") & c(x).try_cast("bigint").isNotNull()


def snowflake_time(x: Column | str) -> Column:
    """The moment in a snowflake id; null for what is no number."""
    return F.timestamp_millis(F.shiftright(c(x).try_cast("bigint"), 22) + F.lit(SNOWFLAKE_EPOCH))


def archive_time(x: Column | str) -> Column:
    """``2018-10-10T20:19:24.000Z`` or ``Wed Oct 10 20:19:24 +0000 2018``; else null."""
    s = c(x)
    return F.when(s.contains("T") & s.endswith("Z"), F.try_to_timestamp(s)).otherwise(F.try_to_timestamp(F.substr(s, F.lit(5)), F.lit("MMM dd HH:mm:ss Z yyyy")))


def inferred_time(created: Column | str, ident: Column | str) -> Column:
    return F.coalesce(c(created), snowflake_time(ident))


def type_priority(kind: Column | str) -> Column:
    out = None
    for name, rank in TYPE_PRIORITY.items():
        out = F.when(c(kind) == name, rank) if out is None else out.when(c(kind) == name, rank)
    return out.otherwise(len(TYPE_PRIORITY) + 1)


def preview(x: Column | str, n: int = 50) -> Column:
    return F.when(c(x).isNull(), "[NULL]").otherwise(F.concat(F.left(c(x), F.lit(n)), F.lit("...")))


#: White space of any script, control separators included.
_SPACE = r"(?U)[\s\x1C-\x1F]+"


def words(x: Column | str) -> Column:
    """Tokens between white space, without empty ones."""
    return F.filter(F.split(c(x), _SPACE), lambda w: w != "")


def clean_text(x: Column | str) -> Column:
    """Without mentions, links and hashtags; one space between words."""
    blank = r"\s\x1C-\x1F"
    kept = F.regexp_replace(c(x), rf"(?U)(?<![^{blank}])(?:@|http|#)[^{blank}]*+", "")
    return F.trim(F.regexp_replace(kept, _SPACE, " "))


def marked_words(x: Column | str, mark: str) -> Column:
    """Distinct words after a mark, sorted: mentions (@), hashtags (#)."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c(x), F.lit(rf"{mark}(\w+)"), F.lit(1))))


def posted(x: Column | str) -> Column:
    return F.date_format(c(x), "yyyy-MM-dd HH:mm:ss")


def days_between(a: Column | str, b: Column | str) -> Column:
    return (F.unix_micros(c(b)) - F.unix_micros(c(a))) / F.lit(86_400_000_000.0)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Null where there is no whole."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)


def safe_name(x: Column | str) -> Column:
    return F.regexp_replace(c(x), "[^a-zA-Z0-9_]", "_")


def user_of_file(x: Column | str) -> Column:
    """Account name of an archive's file name."""
    return F.regexp_replace(F.regexp_extract(c(x), r"([^/]*)$", 1), r"(?:_archive)?\.json$", "")


def temporary_id(username: Column | str) -> Column:
    """A stable stand-in for an unknown user id."""
    return F.concat(F.lit("TEMP_"), F.sha2(c(username), 256))


def is_temporary(user_id: Column | str) -> Column:
    return c(user_id).startswith("TEMP_")
