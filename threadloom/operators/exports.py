"""Exports: Markdown, JSON lines and chat-training records, a row a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import scalar

SYSTEM = "You are a helpful assistant."
_NO_MEDIA = "array<struct<type:string,media_url:string>>"


def _media(posts: DataFrame) -> Column:
    none = F.array().cast(_NO_MEDIA)
    return F.coalesce(F.col("media"), none) if "media" in posts.columns else none


def _joined(items: Column, one) -> Column:
    return F.array_join(F.transform(items, one), "")


def markdown(posts: DataFrame) -> DataFrame:
    """``at, id, line``: each post as a Markdown section, clean text."""
    kind = lambda m: F.concat(F.lit("!["), F.coalesce(m["type"], F.lit("media")), F.lit("]("), F.coalesce(m["media_url"], F.lit("")), F.lit(")\n\n"))
    when = F.when(F.col("created_at").isNotNull(), F.concat(F.lit("Posted on: "), scalar.posted("created_at"), F.lit("\n\n"))).otherwise("")
    line = F.concat(F.lit("# Tweet "), F.col("id").cast("string"), F.lit("\n\n"), scalar.clean_text("text"), F.lit("\n\n"), when, _joined(_media(posts), kind))
    return posts.select(F.col("created_at").alias("at"), "id", line.alias("line"))


def thread_members(roots: DataFrame) -> DataFrame:
    """Direct threads with ``all``: root first, then replies in time."""
    first = F.struct(F.col("root_at").alias("at"), F.col("root_id").alias("id"), F.col("root_text").alias("text"))
    return roots.withColumn("all", F.concat(F.array(first), F.col("replies")))


def markdown_thread(roots: DataFrame) -> DataFrame:
    """``root_id, line``: each thread as a Markdown document, raw text."""
    dated = lambda t: F.when(t["at"].isNotNull(), F.concat(F.lit("## "), scalar.posted(t["at"]), F.lit("\n\n"))).otherwise("")
    body = _joined(F.col("all"), lambda t: F.concat(F.coalesce(dated(t), F.lit("")), F.coalesce(t["text"], F.lit("")), F.lit("\n\n")))
    head = F.concat(F.lit("# Thread started on "), scalar.posted("root_at"), F.lit("\n\n"))
    return thread_members(roots).select("root_id", F.concat(F.coalesce(head, F.lit("")), body).alias("line"))


def _messages(system: str | None, turns: Column) -> Column:
    first = F.struct(F.lit("system").alias("role"), F.lit(system).cast("string").alias("content"))
    return F.to_json(F.struct(F.concat(F.array(first), turns).alias("messages")), {"ignoreNullFields": "false"})


def _turn(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def jsonl_thread(roots: DataFrame, system: str | None = SYSTEM) -> DataFrame:
    """User and assistant in turn, raw text."""
    turns = F.transform("all", lambda t, i: _turn(F.when(i % 2 == 0, "user").otherwise("assistant"), t["text"]))
    return thread_members(roots).select("root_id", _messages(system, turns).alias("line"))


def chat_thread(roots: DataFrame, system: str | None = SYSTEM) -> DataFrame:
    """Roles in turn, each text with the time of its posting; one record a thread."""
    said = lambda t: F.concat(F.coalesce(t["text"], F.lit("")), F.when(t["at"].isNotNull(), F.concat(F.lit("\n[Posted on "), scalar.posted(t["at"]), F.lit("]"))).otherwise(""))
    turns = F.transform("all", lambda t, i: _turn(F.when(i % 2 == 0, "user").otherwise("assistant"), F.coalesce(said(t), t["text"])))
    return thread_members(roots).select("root_id", _messages(system, turns).alias("line"))


def training_thread(roots: DataFrame, system: str | None = SYSTEM) -> DataFrame:
    """All turns by the user, clean text."""
    turns = F.transform("all", lambda t: _turn(F.lit("user"), scalar.clean_text(t["text"])))
    return thread_members(roots).select("root_id", F.col("root_at").alias("at"), _messages(system, turns).alias("line"))


def jsonl(posts: DataFrame, metadata: Column | None = None) -> DataFrame:
    """Each post as a JSON record."""
    iso = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss+00:00")
    record = F.struct(F.col("id").cast("string").alias("id"), F.col("text"), iso.alias("created_at"), _media(posts).alias("media"), (metadata if metadata is not None else F.lit(None).cast("string")).alias("metadata"))
    return posts.select("id", F.to_json(record, {"ignoreNullFields": "false"}).alias("line"))


FORMATS = {"markdown": markdown_thread, "jsonl": jsonl_thread, "oai": training_thread, "chatml": chat_thread}
ENDINGS = {"markdown": "md", "jsonl": "jsonl", "oai": "jsonl", "chatml": "json"}


def export(roots: DataFrame, form: str, system: str | None = SYSTEM) -> DataFrame:
    """Threads in a format by name."""
    if form not in FORMATS:
        raise ValueError(f"unknown format: {form}")
    return markdown_thread(roots) if form == "markdown" else FORMATS[form](roots, system)


def file_name(username: str, form: str) -> str:
    if form not in ENDINGS:
        raise ValueError(f"unknown format: {form}")
    return f"{username}_{form}.{ENDINGS[form]}"


def canonical_json(posts: DataFrame) -> DataFrame:
    """Canonical posts as JSON records, newest first by ``at``."""
    return posts.select(F.col("created_at").alias("at"), "id", F.to_json(F.struct(*posts.columns), {"ignoreNullFields": "false"}).alias("line")).orderBy(F.desc_nulls_last("at"), "id")
