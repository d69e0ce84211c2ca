"""Chat formatting: reply trees, their best branches, and one string per branch.

Messages form trees by (node, parent). Self-joins double the distance of a node's jump with each
round; they give every node the score of its way from the root, and, taken back from the largest
jump to the smallest, all nodes between a chosen leaf and its root. A path of n turns takes about
2 log2(n) joins of narrow rows. Built-in functions only.

Template: each turn is ``<s>role`` and a line break, the text, ``</s>`` and a line break. Control strings
inside roles and texts get a backslash behind their first character (``</s>`` becomes ``<\\/s>``), those
that have some already one more, so taking one away gives the text back. The loss mask is the list of
code point ranges of the assistant's texts.

Defined results: null texts and roles are empty; a node whose parent is not in its tree is a root;
messages on a circle have no root and are left out; of equal scores the smaller leaf is first; a
table without messages gives an empty result; further columns are ignored. A conversation is one
string, so its turns meet in one row; turns are never dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import store, text_of

# Control strings of the template and of its relatives.
CONTROL = r"(<|\[)(\\*)(/?(?:s>|INST\]))"
ESCAPED = r"(<|\[)\\(\\*/?(?:s>|INST\]))"
TURN = r"(?s)<s>([^\n]*)\n(.*?)</s>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2")


def _role(role: Column) -> Column:
    """A role on one line: backslashes and line breaks are written as two characters."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit(r"\b")), F.lit("\n"), F.lit(r"\n")))


def _unrole(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit(r"\n"), F.lit("\n")), F.lit(r"\b"), F.lit("\\"))


def best_paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """``(tree, leaf, node, depth)`` of the nodes on the best branches of each tree.

    ``messages`` has ``(tree, node, parent, score)``; nodes are unique in their tree. A branch has
    the sum of its nodes' scores. ``branches`` says how many each tree keeps (None: all).
    """
    known = messages.select("tree", F.col("node").alias("parent"))
    nodes = store(messages.join(known, ["tree", "parent"], "left_semi").select("tree", "node", "parent", "score").unionByName(
        messages.join(known, ["tree", "parent"], "left_anti").select(
            "tree", "node", F.lit(None).cast(messages.schema["node"].dataType).alias("parent"), "score")))
    rounds = math.ceil(math.log2(max(nodes.count(), 1))) + 1
    state = nodes.select("tree", "node", F.col("parent").alias("jump"), F.coalesce("score", F.lit(0.0)).cast("double").alias("sum"),
                         F.lit(1).cast("long").alias("depth"))
    # Nodes whose jump has reached the root are settled; only the others are joined again.
    rooted, going = state.filter("jump is null"), state.filter("jump is not null")
    jumps = []
    for _ in range(rounds):
        if going.isEmpty():
            break
        jumps.append(going.select("tree", "node", "jump"))
        to = rooted.unionByName(going).select("tree", F.col("node").alias("jump"), F.col("jump").alias("next"),
                                              F.col("sum").alias("more"), F.col("depth").alias("further"))
        moved = store(going.join(to, ["tree", "jump"]).select(
            "tree", "node", F.col("next").alias("jump"), (F.col("sum") + F.col("more")).alias("sum"),
            (F.col("depth") + F.col("further")).alias("depth")))
        rooted, going = rooted.unionByName(moved.filter("jump is null")), moved.filter("jump is not null")
    leaves = rooted.join(nodes.select("tree", F.col("parent").alias("node")), ["tree", "node"], "left_anti")
    if branches is not None:
        ranked = Window.partitionBy("tree").orderBy(F.desc("sum"), "node")
        leaves = leaves.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= branches)
    paths = store(leaves.select("tree", F.col("node").alias("leaf"), "node"))
    for jump in reversed(jumps):
        above = paths.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("jump").alias("node"))
        paths = store(paths.unionByName(above))
    return paths.join(rooted.select("tree", "node", "depth"), ["tree", "node"])


def format_paths(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """``(tree, leaf, formatted, loss)``: one string per branch and the ranges its loss covers.

    ``messages`` has ``(tree, node, role, text)``.
    """
    role, text = _role(text_of("role")), escape(text_of("text"))
    turns = paths.join(messages.select("tree", "node", F.concat(F.lit("<s>"), role, F.lit("\n")).alias("head"), text.alias("body"),
                                       (text_of("role") == "assistant").alias("learn")), ["tree", "node"])
    turns = turns.withColumn("piece", F.concat("head", "body", F.lit("</s>\n")))
    before = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)) + F.length("head")
    turns = turns.select("tree", "leaf", "depth", "piece", "learn", begin.alias("start"), (begin + F.length("body")).alias("stop"))
    whole = turns.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(F.struct("depth", "piece", "learn", "start", "stop"))).alias("turns"))
    loss = F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(t["start"], t["stop"]))
    return whole.select("tree", "leaf", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of a formatted string."""
    roles = F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(1)), _unrole)
    texts = F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(2)), unescape)
    return F.arrays_zip(roles.alias("role"), texts.alias("text"))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    parts = F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))))
    return F.array_join(parts, "")


def format_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """``(conv_id, formatted, loss)`` of tables that list turns: each replies to the one before.

    Rows of one turn stand in the order of role and text. Rows of null ids are one conversation.
    """
    plain = rows.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), text_of("role").alias("role"),
                        text_of("text").alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = store(plain.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"),
                                  F.row_number().over(order).cast("long").alias("node"), "role", "text"))
    messages = numbered.select("tree", "node", (F.col("node") - 1).alias("parent"), F.lit(1.0).alias("score"))
    done = format_paths(best_paths(messages), numbered)
    names = numbered.filter("node = 1").select("conv_id", "tree")
    return done.join(names, "tree").select("conv_id", "formatted", "loss")
