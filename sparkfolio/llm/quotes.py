"""Quotation linking: messages without quotes, in reply order.

A line's quote level is the number of its leading '>' marks. Runs of quoted lines of one level are passages; a passage,
and each of its lines, is normalised (lower case, single spaces) and hashed. Messages are indexed by the hashes of their
own text: whole, by paragraph, by line. A hash belongs to the first message of the conversation that has it, so a passage
quoted by thousands of messages joins one row. A message replies to the match of least quote level (whole passages before
lines, then the latest message); lines under LEAST_LINE characters count where that level has no other match, those of one
message alone first, then longer ones. Threads are ordered by their first turn, and
turns inside a thread; a reply never comes before what it answers. Only DataFrame functions run.

Nulls: a null text is a message without text; rows with a null conversation or turn are kept, link with nothing and
stand alone. Empty tables give no rows. Repeated (conversation, turn) rows are kept and share one place in the reply
graph. Ties in a turn are ordered by role and text. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .host_rules import let

LEAST_LINE = 20
#: Turns of a thread are counted in blocks of so many, so that a very long conversation is no single task.
BLOCK = 1024
_MARK = "^ ?((?:> ?)+)"


def normal(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " ")))


def _lines(text: Column) -> Column:
    """[(level, body)] of the lines."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda x: F.struct(F.length(F.translate(F.regexp_extract(x, _MARK, 1), " ", "")).alias("level"), F.regexp_replace(x, _MARK, "").alias("body")),
    )


def own_text(lines: Column) -> Column:
    """Lines of level 0, without the 'X wrote:' lines right before a quote; blank ends trimmed."""

    def kept(x: Column, i: Column) -> Column:
        introduces = x.body.rlike("wrote:\\s*$") & F.coalesce(F.get(lines, i + 1).level > 0, F.lit(False))
        return (x.level == 0) & ~introduces

    return F.regexp_replace(F.array_join(F.transform(F.filter(lines, kept), lambda x: x.body), "\n"), "^\\s+|\\s+$", "")


def passages(lines: Column) -> Column:
    """[(level, whole, unit)] of the quoted passages and of their lines, normalised."""
    n = F.size(lines)
    first = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (F.get(lines, i).level > 0) & ((i == 0) | (F.get(lines, i).level != F.coalesce(F.get(lines, i - 1).level, F.lit(0)))),
    )
    edges = F.filter(F.sequence(F.lit(0), n), lambda i: (i == n) | (i > 0) & (F.get(lines, i).level != F.get(lines, i - 1).level))

    def passage(i: Column) -> Column:
        end = F.array_min(F.filter(edges, lambda e: e > i))
        body = F.transform(F.slice(lines, i + 1, end - i), lambda x: x.body)
        return F.struct(F.get(lines, i).level.alias("level"), F.lit(1).alias("whole"), normal(F.array_join(body, " ")).alias("unit"))

    single = F.transform(F.filter(lines, lambda x: x.level > 0), lambda x: F.struct(x.level.alias("level"), F.lit(0).alias("whole"), normal(x.body).alias("unit")))
    both = F.concat(F.transform(first, passage), single)
    return F.filter(both, lambda x: x.unit != "")


def originals(own: Column) -> Column:
    """[(unit, short)] of a message's whole text, paragraphs and lines, normalised; short: a line under LEAST_LINE characters."""
    paragraphs = F.transform(F.split(own, "\n[ \\t]*\n"), normal)
    single = F.transform(F.transform(F.split(own, "\n"), normal), lambda x: F.struct(x.alias("unit"), (F.length(x) < LEAST_LINE).alias("short")))
    longer = F.transform(F.concat(F.array(normal(own)), paragraphs), lambda x: F.struct(x.alias("unit"), F.lit(False).alias("short")))
    return F.array_distinct(F.filter(F.concat(longer, single), lambda x: x.unit != ""))


def links(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn) of the messages that quote an earlier one."""
    quoted = parsed.where(F.exists("lines", lambda x: x.level > 0)).select("conv_id", "turn", F.explode(passages(F.col("lines"))).alias("q"))
    quoted = quoted.select("conv_id", "turn", "q.level", "q.whole", F.length("q.unit").alias("size"), F.md5("q.unit").alias("h"))
    units = parsed.select("conv_id", "turn", F.explode(originals(F.col("own"))).alias("u"))
    known = units.groupBy("conv_id", F.md5("u.unit").alias("h"), "u.short").agg(F.min("turn").alias("parent_turn"), (F.min("turn") == F.max("turn")).alias("alone"))
    found = quoted.join(known, ["conv_id", "h"]).where(F.col("parent_turn") < F.col("turn"))
    sure = ~F.col("short") & ((F.col("whole") == 1) | (F.col("size") >= LEAST_LINE))
    rank = F.struct(-F.col("level"), sure, "whole", sure | F.col("alone"), F.when(sure, 0).otherwise(F.col("size")), "parent_turn")
    return found.groupBy("conv_id", "turn").agg(F.max_by("parent_turn", rank).alias("parent_turn"))


def roots(linked: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, root_turn, depth) of linked messages, by pointer doubling: each round halves the way left."""
    at = common.materialize(linked.select("conv_id", "turn", "parent_turn", F.col("parent_turn").alias("root_turn"), F.lit(1).alias("depth")))
    while True:
        up = at.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("further"), F.col("depth").alias("more"))
        step = common.materialize(at.join(up, ["conv_id", "root_turn"], "left"))
        if step.where(F.col("further").isNotNull()).isEmpty():
            return at
        at = step.select("conv_id", "turn", "parent_turn", F.coalesce("further", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))


def link(messages: DataFrame) -> DataFrame:
    """(conv_id, position, turn, role, text without quotes, parent_turn, root_turn, depth, n_quoted_lines) of every message."""
    lines = messages.select("conv_id", "turn", "role", _lines(F.col("text")).alias("lines"))
    parsed = common.materialize(lines.select("conv_id", "turn", "role", "lines", let(F.col("lines"), own_text).alias("own")))
    tree = roots(links(parsed))
    out = parsed.join(tree, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", F.col("own").alias("text"), "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).alias("depth"),
        F.size(F.filter("lines", lambda x: x.level > 0)).alias("n_quoted_lines"), F.floor(F.coalesce("turn", F.lit(0)) / BLOCK).alias("block"),
    )
    out = common.materialize(out)
    place = ["conv_id", "root_turn", "block"]
    before = Window.partitionBy("conv_id").orderBy("root_turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    counts = out.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    for c in place:
        counts = counts.withColumnRenamed(c, f"at_{c}")
    same = out.conv_id.eqNullSafe(counts.at_conv_id) & out.root_turn.eqNullSafe(counts.at_root_turn) & out.block.eqNullSafe(counts.at_block)
    within = Window.partitionBy(*place).orderBy("turn", "role", "text")
    return out.join(counts, same).select(
        "conv_id", (F.col("base") + F.row_number().over(within) - 1).alias("position"), "turn", "role", "text", "parent_turn", "root_turn", "depth", "n_quoted_lines"
    )


def query(spark, sf_dir: str) -> DataFrame:
    return link(common.read(spark, sf_dir, "conversations"))
