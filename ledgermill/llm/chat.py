"""Chat formatting over reply trees (native: DataFrame functions only).

Messages form trees: each has a parent or starts one. Iterative self-joins double the distance that pointers jump, so
depths and path scores of a tree of depth d take log2(d) rounds; branches are ranked by score; only the chosen paths
are laid out, again by doubling. Each path from root to leaf becomes one conversation in a marked-up template."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..shared import running_total
from .common import dropped, null_key, saved, small

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
#: Branches of a tree that one task sorts; those of a wider tree are ranked over range partitions.
WIDE = 200_000


def escaped(text: Column) -> Column:
    """text without control strings: a backslash is doubled, and one is put into each '<|'."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escaped_role(role: Column) -> Column:
    """Also without line feeds, as one ends the role."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column) -> Column:
    """The inverse of escaped() and escaped_role(): reads pairs that begin with a backslash from the left."""
    parts = F.split(text, r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|"))), "\\")


def _once(messages: DataFrame, *fields: str) -> DataFrame:
    """A row per (tree, node): of repeated ones the smallest by parent, then the other fields, nulls first. So the same row is
    taken whether or not its text is read."""
    return messages.groupBy("tree", "node").agg(F.min(F.struct(*fields)).alias("_m")).select("tree", "node", "_m.*")


def _ranked(leaves: DataFrame, best: int | None) -> DataFrame:
    """leaves (saved; tree, node, size, path_score) with rank in their tree. Trees of over WIDE branches are ranked by running
    counts over range partitions, so no task sees all branches of one."""
    wide = saved(leaves.groupBy("tree").agg(F.count("*").alias("n")).where(F.col("n") > WIDE).select("tree"), "chat-wide")
    by_window = F.row_number().over(W.partitionBy("tree").orderBy(F.desc("path_score"), "size", "node")).cast("long")
    if wide.isEmpty():
        ranked = leaves.withColumn("rank", by_window)
    else:
        place = F.struct("tree", (0.0 - F.col("path_score")).alias("last"), "size", "node")
        numbers = running_total(leaves.join(small(wide), "tree", "left_semi").select(place.alias("place"), F.lit(1).alias("one")), "place", "one", "number").select("place.tree", "place.node", "number")
        numbers = saved(numbers, "chat-numbers")
        begin = numbers.groupBy("tree").agg((F.min("number") - 1).alias("begin"))
        ranks = numbers.join(begin, "tree").select("tree", "node", (F.col("number") - F.col("begin")).alias("rank"))
        ranked = leaves.join(small(wide), "tree", "left_anti").withColumn("rank", by_window).unionByName(leaves.join(ranks, ["tree", "node"]))
    return ranked if best is None else ranked.where(F.col("rank") <= best)


def reply_paths(messages: DataFrame, best: int | None = None, unique: bool = False) -> DataFrame:
    """messages: tree, node, parent (null or absent from the tree: a root), score. Returns tree, leaf, node, depth (0 at the
    root), path_score and rank: a row per message of each chosen path. The best paths of a tree are those with the
    highest mean score, then the shallower, then the smaller leaf; best None: all.

    Messages on a cycle, or below one, have no root and are on no path, nor are those without a tree or a node. Null and
    NaN scores count 0. Rows that repeat a node are one message: the row with the smallest parent (null first), then score;
    unique says that there are none, which saves a shuffle. An empty table gives no rows; other columns aren't read."""
    rows = messages.where("tree is not null and node is not null").select("tree", "node", "parent", "score")
    rows = rows if unique else _once(rows, "parent", "score")
    base = saved(rows.withColumn("score", F.nanvl(F.coalesce(F.col("score").cast("double"), F.lit(0.0)), F.lit(0.0))), "chat-messages")
    present = base.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    state = base.join(present, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("there"), F.col("parent")).alias("jump"), F.lit(1).cast("long").alias("size"), F.col("score").alias("total")
    )
    state = saved(state, "chat-jumps")
    # Messages whose pointer has passed the root are done: they take no part in later rounds but as what others reach.
    done, active = state.where("jump is null"), state.where("jump is not null")
    levels, rounds = [], math.ceil(math.log2(max(2, base.count()))) + 1
    while len(levels) < rounds and not active.isEmpty():
        far = active.unionByName(done).select("tree", F.col("node").alias("jump"), F.col("jump").alias("next"), F.col("size").alias("more"), F.col("total").alias("plus"))
        doubled = active.join(far, ["tree", "jump"]).select("tree", "node", F.col("next").alias("jump"), (F.col("size") + F.col("more")).alias("size"), (F.col("total") + F.col("plus")).alias("total"))
        doubled = saved(doubled, "chat-jumps")
        levels.append(active)
        done, active = done.unionByName(doubled.where("jump is null")), doubled.where("jump is not null")
    rooted = done.select("tree", "node", "size", "total")
    parents = base.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = saved(rooted.join(parents, ["tree", "node"], "left_anti").withColumn("path_score", F.col("total") / F.col("size")), "chat-leaves")
    paths = saved(_ranked(leaves, best).select("tree", F.col("node").alias("leaf"), "node", (F.col("size") - 1).alias("depth"), "path_score", "rank"), "chat-paths")
    for k, level in enumerate(levels):  # messages up to 2 ** k above a leaf are there; now up to 2 ** (k + 1)
        up = level.where("jump is not null").select("tree", "node", "jump")
        above = paths.join(up, ["tree", "node"]).select("tree", "leaf", F.col("jump").alias("node"), (F.col("depth") - (1 << k)).alias("depth"), "path_score", "rank")
        more = saved(paths.unionByName(above), "chat-paths")
        dropped(paths)
        paths = more
    return paths


def formatted(messages: DataFrame, best: int | None = None, unique: bool = False) -> DataFrame:
    """messages: tree, node, parent, score, role, text. A row per chosen path: tree, leaf, rank, path_score, formatted and
    loss_spans, an array of (start, length) in code points from 0: the assistant's texts, which alone are trained on.

    A turn is <|im_start|>role, a line feed, the text, <|im_end|> and a line feed. Roles and texts are escaped, so they hold
    no control string and come back exactly. Null roles and texts are empty. Nodes that repeat, nulls and empty tables as in
    reply_paths(); of rows equal in parent and score the smallest role and text count. A path is one row by nature; all
    before it is dealt out by message."""
    if not unique:
        messages = _once(messages.where("tree is not null and node is not null"), "parent", "score", "role", "text")
    content, role = escaped(F.coalesce("text", F.lit(""))), escaped_role(F.coalesce("role", F.lit("")))
    turns = messages.select("tree", "node", F.concat(F.lit(START), role, F.lit("\n")).alias("head"), content.alias("body"), (F.coalesce("role", F.lit("")) == ASSISTANT).alias("trained"))
    rows = reply_paths(messages, best, unique=True).join(turns, ["tree", "node"])
    size = F.length("head") + F.length("body") + len(END) + 1
    before = W.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    one = F.struct("depth", F.concat("head", "body", F.lit(END + "\n")).alias("turn"), "start", F.length("body").cast("long").alias("length"), "trained")
    paths = rows.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(one)).alias("turns"), F.first("rank").alias("rank"), F.first("path_score").alias("path_score"))
    spans = F.transform(F.filter("turns", lambda t: t["trained"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    return paths.select("tree", "leaf", "rank", "path_score", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"), spans.alias("loss_spans"))


def threads(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Linear conversations as reply trees: a turn's parent is the one before it, rows by turn, then role and text, nulls first.
    Repeated rows are turns of their own, as nodes are numbered; rows without a conversation are one conversation."""
    tree = null_key(F.col(conv_col))
    order = W.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(tree.alias("tree"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    bodies = F.transform(parts, lambda p: F.substr(p, F.lit(1), F.length(p) - (len(END) + 1)))
    return F.transform(
        bodies,
        lambda p: F.struct(unescaped(F.substring_index(p, "\n", 1)).alias("role"), unescaped(F.substr(p, F.instr(p, F.lit("\n")) + 1)).alias("text")),
    )
