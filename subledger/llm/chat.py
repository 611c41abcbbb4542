"""Chat formatting by quotation linking.

1. Lines that begin with ``>`` marks are quotations; the number of marks is the nesting level.  A passage is a run of lines of one
   level.  Quoted passages and lines are normalised (white space, letter case) and hashed.
2. Hashes are joined to the conversation's earlier messages' own (unquoted) text, paragraphs, lines, sentences and stretches of
   ``SHINGLE`` words across lines.  The latest earlier message that holds the whole passage as one of these is its origin; else the
   earlier message that holds the most of its words, ``SIMILARITY`` of them at least, in equal lines or stretches (the latest, if several).
   A quotation of fewer than ``SHINGLE`` words is linked only as a whole text, paragraph, line or sentence.
3. A message replies to the origin of its shallowest linked quotation (the latest, if several), or else to the message before it.  A reply to
   an older message opens a branch; the branch's messages follow it in order.
4. The output is each message without its quotations, with its place in the reply order: ``branch_turn`` (first turn of its branch)
   and ``position`` in the branch; a branch's first message replies to ``parent_turn``.

A quotation of which no origin is known is removed too and counted in ``n_quotes`` only.

Conversations may be of any length: "the latest earlier row" is taken per stretch of ``STRETCH`` turns with running values carried
between stretches, so that no task holds a whole conversation.

Defined results: null and empty texts are messages without own text; a null conv_id or turn is kept, replies to nothing and is its own
branch; rows that repeat (conv_id, turn) are each kept, in a fixed order; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.llm.common import stored

STRETCH = 1024
SIMILARITY = 0.8
SHINGLE = 4
QUOTE = r"^((?:[ \t]*>)+)[ \t]?"


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _is_quote(line: Column) -> Column:
    return line.rlike(r"^[ \t]*>")


def last_before(rows: DataFrame, keys: list[str], turn: str, value: str, out: str) -> DataFrame:
    """``out``: the greatest non-null ``value`` of the rows of a key with a smaller ``turn``."""
    cut = rows.withColumn("__stretch", F.floor(F.col(turn) / STRETCH))
    whole = cut.groupBy(*keys, "__stretch").agg(F.max(value).alias("__top"))
    before = Window.partitionBy(*keys).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.withColumn("__carried", F.max("__top").over(before)).drop("__top")
    inside = Window.partitionBy(*keys, "__stretch").orderBy(turn).rangeBetween(Window.unboundedPreceding, -1)
    joined = cut.withColumn("__here", F.max(value).over(inside)).join(whole, [*keys, "__stretch"])
    return joined.withColumn(out, F.coalesce("__here", "__carried")).drop("__here", "__carried", "__stretch")


def quoted_passages(messages: DataFrame) -> DataFrame:
    """One row per quoted passage: ``conv, turn, row_no, passage, level, lines``."""
    lines = messages.where(F.col("text").rlike(r"(?m)^[ \t]*>")).select(
        "conv", "turn", "row_no", F.posexplode(F.split("text", "\r?\n")).alias("i", "line"))
    marked = lines.withColumn("level", F.length(F.regexp_replace(F.regexp_extract("line", QUOTE, 1), r"[^>]", "")))
    # within one message: a passage begins where the level changes
    order = Window.partitionBy("row_no").orderBy("i")
    begun = marked.withColumn("new", (F.col("level") != F.lag("level", 1, -1).over(order)).cast("int"))
    numbered = begun.withColumn("passage", F.sum("new").over(order)).where("level > 0")
    body = numbered.withColumn("body", normalised(F.regexp_replace("line", QUOTE, ""))).where("body <> ''")
    earlier = Window.partitionBy("row_no", "passage").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    body = body.withColumn("n", F.size(F.split("body", " "))).withColumn("at", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("int"))
    return body.groupBy("conv", "turn", "row_no", "passage", "level").agg(
        F.sort_array(F.collect_list(F.struct("i", "body", "at", "n"))).alias("lines"))


def _shingles(words: str) -> Column:
    """Every ``SHINGLE`` neighbouring words."""
    starts = F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))


def link_passages(messages: DataFrame) -> DataFrame:
    """``row_no, passage, level, origin``: the turn of the message that each quoted passage comes from (null: unknown)."""
    spark, key = messages.sparkSession, ["row_no", "passage"]
    passages = quoted_passages(messages).withColumn("text", F.array_join(F.transform("lines", lambda x: x["body"]), " ")) \
        .withColumn("words", F.split("text", " ")).withColumn("size", F.size("words"))
    part = lambda whole, at, n, text: F.struct(
        F.lit(whole).alias("whole"), at.alias("at"), n.alias("n"), F.xxhash64(text).alias("hash"))
    parts = F.concat(F.array(part(True, F.lit(0), F.col("size"), F.col("text"))),
                     F.transform("lines", lambda x: part(False, x["at"], x["n"], x["body"])),
                     F.transform(_shingles("words"), lambda x, i: part(False, i, F.lit(SHINGLE), x)))
    asked = stored(spark, passages.select("conv", "turn", *key, "level", "size", F.inline(parts)), "quoted-parts")
    own = messages.join(asked.select("conv").distinct(), "conv", "left_semi").select("conv", "turn", F.array_join(F.filter(
        F.split("text", "\r?\n"), lambda x: ~_is_quote(x)), "\n").alias("body")).withColumn("flat", normalised(F.col("body")))
    own = own.withColumn("words", F.split("flat", " "))
    pieces = F.transform(F.concat(F.array("body"), F.split("body", r"\n\s*\n"), F.split("body", "\n")), normalised)
    pieces = F.concat(pieces, F.split("flat", r"(?<=[.!?])\s+"), _shingles("words"))
    held = own.select("conv", "turn", F.explode(F.array_distinct(pieces)).alias("part")).where("part <> ''") \
        .select("conv", "turn", F.xxhash64("part").alias("hash"))
    held = stored(spark, held.join(asked.select("conv", "hash").distinct(), ["conv", "hash"], "left_semi")
                  .select("conv", "turn", "hash").distinct(), "held-parts")
    nothing, whole = F.lit(None), asked.where("whole")
    timeline = whole.select("conv", "hash", "turn", *key, "level", nothing.cast("long").alias("held")) \
        .unionByName(held.join(whole.select("conv", "hash").distinct(), ["conv", "hash"], "left_semi").select(
            "conv", "hash", "turn", *(nothing.alias(c) for c in (*key, "level")), F.col("turn").alias("held")))
    found = stored(spark, last_before(timeline, ["conv", "hash"], "turn", "held", "origin").where("row_no IS NOT NULL").select(
        *key, "level", "origin"), "whole-quotations")
    best = _most_similar(asked.where("NOT whole").join(found.where("origin IS NULL").select(*key), key, "left_semi"), held)
    return found.join(best, key, "left").select(*key, "level", F.coalesce("origin", "similar").alias("origin"))


def _most_similar(asked: DataFrame, held: DataFrame) -> DataFrame:
    """``row_no, passage, similar``: the earlier message that holds the most words of a passage, ``SIMILARITY`` of them at least.

    A word costs as many messages as hold the most frequent part around it.  A message without any part of the cheapest words,
    one word more than may be missing, can't be similar enough: so only the holders of those parts are compared, and lines that
    every message holds pair no messages as long as other words of the passage are rarer.
    """
    key = ["row_no", "passage"]
    counted = asked.join(held.groupBy("conv", "hash").agg(F.count("*").alias("holders")), ["conv", "hash"])
    cost = counted.select(*key, "size", "holders", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("word")) \
        .groupBy(*key, "size", "word").agg(F.max("holders").alias("cost"))
    missing = F.floor((1 - SIMILARITY) * F.col("size") + 1e-9).cast("int")
    limits = cost.groupBy(*key, "size").agg(F.sort_array(F.collect_list("cost")).alias("costs")).select(
        *key, F.get("costs", missing - (F.col("size") - F.size("costs"))).alias("limit")).where("limit IS NOT NULL")
    origins = held.select("conv", "hash", F.col("turn").alias("similar"))
    candidates = counted.join(limits, key).where("holders <= limit").join(origins, ["conv", "hash"]).where("similar < turn") \
        .select(*key, "similar").distinct()
    covered = asked.join(candidates, key).join(origins, ["conv", "hash", "similar"]).select(
        *key, "size", "similar", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("word")).distinct() \
        .groupBy(*key, "size", "similar").agg(F.count("*").alias("weight"))
    return covered.where(F.col("weight") >= SIMILARITY * F.col("size") - 1e-9).groupBy(*key).agg(
        F.max(F.struct("weight", "similar"))["similar"].alias("similar"))


def link_quotations(spark: SparkSession, conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: ``conv_id, turn, role, text`` (no quotations), ``parent_turn, n_quotes, n_linked, branch_turn, position``.

    Texts are read for the quotations and once more for the output; the reply order is worked out on ids alone, and each of its
    steps is stored.
    """
    source = conversations
    messages = source.select(source[conv_col].cast("long").alias("conv"), source[turn_col].cast("long").alias("turn"),
                             source[role_col].cast("string").alias("role"), F.coalesce(source[text_col], F.lit("")).alias("text"))
    # equal rows share a number and so one fate
    messages = messages.withColumn("row_no", F.xxhash64("conv", "turn", "role", "text"))
    links = stored(spark, link_passages(messages.dropDuplicates(["row_no"])).groupBy("row_no").agg(
        F.count("*").alias("n_quotes"), F.count("origin").alias("n_linked"),
        F.max(F.when(F.col("origin").isNotNull(), F.struct((-F.col("level")).alias("l"), "origin")))["origin"].alias("quoted_turn")),
        "quotations")
    linked = messages.where("conv IS NOT NULL AND turn IS NOT NULL").select(
        "conv", "turn", "row_no", F.col("turn").alias("own_turn")).join(links, "row_no", "left")
    before = last_before(linked, ["conv"], "turn", "own_turn", "previous")
    placed = stored(spark, before.withColumn("opens", F.when(
        F.col("previous").isNull() | (F.col("quoted_turn") < F.col("previous")), F.col("turn"))), "replies")
    # the branch is opened at the latest opening turn up to the message's own
    branched = stored(spark, last_before(placed, ["conv"], "turn", "opens", "earlier").select(
        "conv", "turn", "row_no", F.coalesce("opens", "earlier").alias("branch_turn"), F.floor(F.col("turn") / STRETCH).alias("turn_group"),
        F.when(F.col("opens").isNotNull(), F.col("quoted_turn")).otherwise(F.col("previous")).alias("parent_turn"),
        F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked")),
        "branches")
    lone = messages.where("conv IS NULL OR turn IS NULL").select(
        "conv", "turn", "row_no", F.col("turn").alias("branch_turn"), F.lit(None).cast("long").alias("parent_turn"),
        F.lit(0).cast("long").alias("n_quotes"), F.lit(0).cast("long").alias("n_linked"), F.lit(0).cast("long").alias("position"))
    rows = _positions(branched).select(*lone.columns).unionByName(lone)
    text = F.trim(F.regexp_replace(F.array_join(F.filter(F.split("text", "\r?\n"), lambda x: ~_is_quote(x)), "\n"), r"\n{3,}", "\n\n"))
    texts = messages.dropDuplicates(["row_no"]).select("row_no", "role", text.alias("text"))
    return rows.join(texts, "row_no").select(
        F.col("conv").alias("conv_id"), "turn", "role", "text", "parent_turn", "n_quotes", "n_linked", "branch_turn", "position")


def _positions(rows: DataFrame) -> DataFrame:
    """``position`` in the branch, from 0: rows of earlier stretches are counted, not gathered."""
    counts = rows.groupBy("conv", "branch_turn", "turn_group").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv", "branch_turn").orderBy("turn_group").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("skipped", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = Window.partitionBy("conv", "branch_turn", "turn_group").orderBy("turn", "row_no")
    return rows.withColumn("place", F.row_number().over(inside)).join(counts, ["conv", "branch_turn", "turn_group"]).withColumn(
        "position", (F.col("skipped") + F.col("place") - 1).cast("long"))
