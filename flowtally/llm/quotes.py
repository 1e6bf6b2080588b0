"""Quotation linking: reply-ordered conversations without the quotes that tie them.

A line that starts with ``>`` marks is quoted, at the level of their number. Neighbouring
lines of one level are a passage. Passages and their lines are hashed after lower-casing and
joining white space, and looked up among what messages of the same conversation wrote
themselves (whole, by paragraph or by line). A message replies to the earliest message that
wrote what it quotes at the lowest level; more matching words win, then the later message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.llm.components import components
from flowtally.session import stage

_ATTRIBUTION = r"(?i)^on\b.*\bwrote:\s*$"

PARSED = r"""
transform(
  split(text, '\n'),
  x -> named_struct(
    'level', length(regexp_replace(regexp_extract(x, '^((?:[ \\t]*>)+)', 1), '[ \\t]', '')),
    'body', trim(regexp_replace(x, '^(?:[ \\t]*>)+', ''))))"""


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _n_words(text: Column) -> Column:
    return F.size(F.split(text, " "))


def _hashes(texts: Column) -> Column:
    """``(h1, h2, words)`` of normalised texts that are not blank, each once."""
    fit = F.filter(F.transform(texts, normal), lambda t: t != "")
    return F.array_distinct(
        F.transform(fit, lambda t: F.struct(F.xxhash64(t).alias("h1"), F.xxhash64(t, F.lit(7)).alias("h2"), _n_words(t).alias("words")))
    )


def parsed(messages: DataFrame) -> DataFrame:
    """Add ``own``, the text without quotes, and ``passages`` of ``(level, lines)``."""
    lines = messages.withColumn("_lines", F.coalesce(F.expr(PARSED), F.array().cast("array<struct<level:int,body:string>>")))
    # A line that names who is quoted belongs to the quote below it.
    marked = lines.withColumn(
        "_lines",
        F.transform(
            "_lines",
            lambda x, i: F.when(
                (x["level"] == 0) & x["body"].rlike(_ATTRIBUTION) & (F.coalesce(F.get("_lines", i + 1)["level"], F.lit(0)) > 0),
                F.struct(F.lit(-1).alias("level"), x["body"].alias("body")),
            ).otherwise(x),
        ),
    )
    begins = F.filter(
        F.sequence(F.lit(1), F.size("_lines")),
        lambda i: (i == 1) | (F.get("_lines", i - 1)["level"] != F.get("_lines", i - 2)["level"]),
    )
    cut = marked.withColumn("_begins", F.when(F.size("_lines") > 0, begins).otherwise(F.array().cast("array<int>")))
    runs = F.transform(
        "_begins",
        lambda b, k: F.struct(
            F.get("_lines", b - 1)["level"].alias("level"),
            F.transform(
                F.slice("_lines", b, F.coalesce(F.get("_begins", k + 1), F.size("_lines") + 1) - b), lambda x: x["body"]
            ).alias("lines"),
        ),
    )
    done = cut.withColumn("_runs", runs)
    own = F.flatten(F.transform(F.filter("_runs", lambda r: r["level"] == 0), lambda r: r["lines"]))
    return (
        done.withColumn("own", F.when(F.col("text").isNotNull(), F.trim(F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", ""))))
        .withColumn("passages", F.filter("_runs", lambda r: r["level"] > 0))
        .drop("_lines", "_begins", "_runs")
    )


def linked(conversations: DataFrame) -> DataFrame:
    """One row per message: ``conv_id, turn, role, text`` (without quotes), ``n_passages``,
    ``max_level``, ``n_linked`` passages and lines found again, ``reply_to`` (a turn) and
    ``thread`` (the first turn of the messages tied to it), in the order conversation,
    thread, turn.

    Passages of any length and script count, because only messages of the same conversation
    are asked. Only earlier turns can be replied to. A message that quotes nothing known is a thread of
    its own, which in a plain chat leaves the order of turns. Rows that share a conversation
    and a turn are one message as far as links go, and all stay. A missing turn comes last
    and takes part in no link; a missing conversation is one of its own; NULL text stays
    NULL; an empty table gives no rows; further columns are not read.
    """
    messages = conversations.select(
        "conv_id", "turn", "role", "text",
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("missing")).alias("conv"),
        F.col("turn").cast("bigint").alias("at"),
    )
    read = stage(parsed(messages), "messages")
    placed = read.where("at IS NOT NULL")
    written = F.concat(F.array("own"), F.split("own", r"\n\s*\n"), F.split("own", "\n"))
    originals = (
        placed.where("own <> ''")
        .select("conv", "at", F.explode(_hashes(written)).alias("h"))
        .groupBy("conv", F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2"))
        .agg(F.min("at").alias("source"))
    )
    quoted = placed.select("conv", "at", F.explode("passages").alias("p")).select(
        "conv", "at", F.col("p.level").alias("level"),
        F.explode(_hashes(F.concat(F.array(F.array_join("p.lines", " ")), F.col("p.lines")))).alias("h"),
    ).select("conv", "at", "level", "h.*")
    found = quoted.join(originals, ["conv", "h1", "h2"]).where(F.col("source") < F.col("at"))
    replies = stage(
        found.groupBy("conv", "at", "level", "source")
        .agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("n"))
        .groupBy("conv", "at")
        .agg(F.max(F.struct(-F.col("level"), "words", "source"))["source"].alias("reply_to"), F.sum("n").alias("n_linked")),
        "replies",
    )
    node = lambda turn: F.xxhash64("conv", turn)
    groups = components(replies.select(node("at").alias("u"), node("reply_to").alias("v")))
    tied = replies.select("conv", "at").union(replies.select("conv", "reply_to")).distinct().withColumn("node", node("at"))
    named = tied.join(groups, "node")
    threads = named.join(named.groupBy("root").agg(F.min("at").alias("thread")), "root").select("conv", "at", "thread")
    return (
        read.join(replies, ["conv", "at"], "left")
        .join(threads, ["conv", "at"], "left")
        .select(
            "conv_id", "turn", "role", F.col("own").alias("text"),
            F.size("passages").cast("bigint").alias("n_passages"),
            F.coalesce(F.array_max(F.transform("passages", lambda p: p["level"])), F.lit(0)).alias("max_level"),
            F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"), "reply_to",
            F.coalesce("thread", "at").alias("thread"),
        )
        .orderBy("conv_id", F.asc_nulls_last("thread"), F.asc_nulls_last("turn"), "role", "text")
    )
