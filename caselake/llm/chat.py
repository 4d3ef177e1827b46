"""Reply trees to training conversations.

Iterative self-joins follow parent links, doubling the distance each round, so the number of joins
is logarithmic in the depth. They give each node its depth and the score of its path from the
root; leaves are ranked by that score, and the same links, walked back from the chosen leaves,
enumerate the paths, each formatted as one conversation.

A turn is written as ``### role: text</turn>`` and a line end. In roles and texts a backslash
becomes ``\\0``, ``#`` ``\\1``, ``<`` ``\\2``, and in roles ``:`` ``\\3``, so no text can hold a mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.common import stage

HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
# In this order when escaping, in the reverse when reading: the backslash is first and last.
ESCAPES = (("\\", "\\0"), ("#", "\\1"), ("<", "\\2"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\3"))
TRAINED_ROLE = "assistant"


def escape(text: Column, escapes=ESCAPES) -> Column:
    for plain, safe in escapes:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column, escapes=ESCAPES) -> Column:
    for plain, safe in reversed(escapes):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def _ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Links by level, and every node's whole path.

    Level k: (tree, node, up, score, depth) for the nodes that have a 2^k-th ancestor ``up``, with the
    score and number of nodes from the node to below it. The path table has the same columns, up
    null, once the root is reached; such nodes take no part in further joins. Nodes on, or hanging
    from, a cycle of parent links never get there; the largest tree bounds the levels.
    """
    keys = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    state = stage(nodes.join(keys, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), "score", F.lit(1).cast("bigint").alias("depth")), "chat-links")
    largest = state.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    levels, whole = [], state.where("up IS NULL")
    while True:
        levels.append(state.where("up IS NOT NULL"))
        if 1 << len(levels) - 1 >= largest or levels[-1].isEmpty():
            return levels, whole
        above = levels[-1].union(whole).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("score").alias("score2"), F.col("depth").alias("depth2"))
        state = stage(levels[-1].join(above, ["tree", "up"]).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("score") + F.col("score2")).alias("score"),
            (F.col("depth") + F.col("depth2")).alias("depth")), "chat-links")
        whole = whole.union(state.where("up IS NULL"))


def chosen_paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """(tree, branch, node, depth): the nodes of the ``best`` paths of each tree.

    ``nodes``: tree, node, parent (bigint), score (double); a parent that is null or not in the tree
    makes a root. A branch is named by its leaf. Branches rank by the sum of their scores, then
    by length, then by the smaller leaf. Nodes on a cycle or below one are on no path. Nodes whose
    tree is null are one tree.
    """
    return _paths(nodes.withColumn("tree", F.struct("tree")), best).withColumn("tree", F.col("tree.tree"))


def _paths(nodes: DataFrame, best: int) -> DataFrame:
    """``chosen_paths`` with trees as structs: those are equal, and meet in joins, if both hold a null."""
    levels, whole = _ancestors(nodes)
    parents = levels[0].select("tree", F.col("up").alias("node")).distinct()
    leaves = whole.join(parents, ["tree", "node"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "node"))
    marked = leaves.withColumn("rank", rank).where(F.col("rank") <= best).select("tree", F.col("node").alias("branch"), "node")
    for level in reversed(levels):
        marked = stage(marked, "chat-paths")
        up = marked.join(level, ["tree", "node"]).select("tree", "branch", F.col("up").alias("node"))
        marked = marked.union(up)  # distances 0, 2^k and sums of such: no node comes twice
    return marked.join(whole.select("tree", "node", "depth"), ["tree", "node"]).select("tree", "branch", "node", "depth")


def format_conversations(nodes: DataFrame, best: int = 1) -> DataFrame:
    """(tree, branch, formatted, mask): each chosen path as one string; ``mask`` lists the code-point
    intervals (start, end) of the texts to train on, those of assistant turns.

    ``nodes``: tree, node, parent, score, role, text. Null roles and texts are empty; (tree, node)
    is unique; a tree whose nodes all hang on a cycle gives no row; nodes whose tree is null are one
    tree; an empty table gives none.
    """
    nodes = nodes.withColumn("tree", F.struct("tree"))
    paths = _paths(nodes.select("tree", "node", "parent", F.col("score").cast("double").alias("score")), best)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = paths.join(nodes.select("tree", "node", "role", "text"), ["tree", "node"]).select(
        "tree", "branch", "depth", (F.lower(role) == TRAINED_ROLE).alias("trained"),
        F.concat(F.lit(HEAD), escape(role, ROLE_ESCAPES), F.lit(MIDDLE)).alias("head"), escape(text).alias("body"))
    sofar = Window.partitionBy("tree", "branch").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    piece = F.concat("head", "body", F.lit(END))
    rows = rows.withColumn("piece", piece).withColumn("last", F.sum(F.length("piece")).over(sofar) - len(END))
    span = F.struct((F.col("last") - F.length("body")).alias("start"), F.col("last").alias("end"))
    turns = F.array_sort(F.collect_list(F.struct("depth", "piece")))
    spans = F.array_sort(F.collect_list(F.when(F.col("trained"), span)))
    return rows.groupBy("tree", "branch").agg(turns.alias("turns"), spans.alias("mask")).select(
        F.col("tree.tree").alias("tree"), "branch", F.array_join(F.col("turns")["piece"], "").alias("formatted"), "mask")


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    pieces = F.split(formatted, END, -1)
    body = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.substring(p, len(HEAD) + 1, 1 << 30))
    return F.transform(body, lambda p: F.struct(
        unescape(F.substring_index(p, MIDDLE, 1), ROLE_ESCAPES).alias("role"),
        unescape(F.substr(p, F.instr(p, MIDDLE) + len(MIDDLE))).alias("text")))


def masked_text(formatted: Column, mask: Column) -> Column:
    """The text under the mask, unescaped."""
    return F.array_join(F.transform(mask, lambda m: unescape(
        F.substr(formatted, (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))), "")


def conversation_nodes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                       text_col: str = "text") -> DataFrame:
    """Rows by turn as trees of one branch: each row replies to the row before it, rows of equal turns
    in the order of their role and text; null turns come first. The score is the text's length."""
    rows = turns.select(
        F.col(conv_col).cast("bigint").alias("tree"), F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    node = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("bigint")
    return rows.withColumn("node", node).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.length("text").cast("double").alias("score"), "role", "text")
