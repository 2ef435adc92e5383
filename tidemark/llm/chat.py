"""Chat formatting: reply trees to conversations.

Messages form trees by `parent_id`.  Self-joins with doubling steps (1, 2, 4, ... ancestors) give every message its
path length and path score and unfold each chosen leaf into its root-to-leaf path, in a number of joins that is
logarithmic in the depth.  Leaves are ranked inside their tree by path score; the chosen paths become one
formatted conversation each, with the spans of the assistant's text as loss mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import cut

# Fixed values of the template: a turn is HEAD role, line end, text, TAIL.
HEAD, TAIL = "### ", "\n</turn>\n"


def escape_text(text: Column) -> Column:
    """No turn mark survives inside: `\\`, `###` and `</turn>` get a backslash in front."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(\\|###|</turn>)", r"\\$1")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\|###|</turn>)", "$1")


def escape_role(role: Column) -> Column:
    """Also keeps the role on one line."""
    return F.replace(escape_text(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"), r"\\(\\|###|</turn>)", "$1")


def threads(messages: DataFrame, tree: str, turn: str, role: str, text: str) -> DataFrame:
    """A table of turns as messages: each turn answers the one before it.

    Turns are taken by (turn, role, text), nulls first, so repeated turns have a defined order; a null tree is a
    conversation of its own.
    """
    order = Window.partitionBy(tree).orderBy(turn, role, text)
    number = F.row_number().over(order).cast("long")
    return messages.select(
        F.col(tree).alias("tree"), number.alias("message_id"),
        F.when(number > 1, number - 1).alias("parent_id"), F.col(role).alias("role"), F.col(text).alias("text"),
        F.lit(0.0).alias("score"),
    )


def _key(tree: Column, message: Column) -> Column:
    """Null-safe identity of a message."""
    return F.struct(tree.isNull().alias("none"), F.coalesce(tree.cast("string"), F.lit("")).alias("tree"),
                    message.alias("id"))


def paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """(leaf, depth, node, ...) rows of the chosen root-to-leaf paths, depth counted from the leaf, with path_score.

    `messages` has (tree, message_id, parent_id, role, text, score).  `best` keeps that many leaves of each tree,
    by path score (sum over the path), ties by smaller message id; None keeps all.  A parent that does not exist
    makes its child a root.  Of rows with one (tree, message_id) the least (parent_id, role, text, score) counts,
    rows without a message_id are ignored, a null score counts 0.  A pure cycle has no leaf and appears in no
    path; replies that hang on a cycle raise an error.
    """
    unique = messages.where("message_id is not null").groupBy("tree", "message_id").agg(
        F.min(F.struct("parent_id", "role", "text", "score")).alias("m")
    ).select("tree", "message_id", "m.*")
    keyed = unique.withColumns({
        "node": _key(F.col("tree"), F.col("message_id")),
        "parent": F.when(F.col("parent_id").isNotNull(), _key(F.col("tree"), F.col("parent_id"))),
    })
    nodes = keyed.select("node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = nodes.select(F.col("node").alias("parent")).withColumn("there", F.lit(True))
    nodes = cut(nodes.join(known, "parent", "left").select(
        "node", F.when(F.col("there"), F.col("parent")).alias("parent"), "score"
    ))
    inner = nodes.where("parent is not null").select(F.col("parent").alias("node")).distinct()
    leaves = nodes.join(inner, "node", "left_anti")
    # gain: sum of the scores from the leaf to just below the node
    reached = leaves.select(F.col("node").alias("leaf"), "node", F.lit(0).alias("depth"), F.lit(0.0).alias("gain"))
    jumps = nodes.where("parent is not null").select("node", F.col("parent").alias("up"), F.col("score").alias("more"))
    for step in range(40):
        longer = cut(reached.join(jumps, "node").select(
            "leaf", F.col("up").alias("node"), (F.col("depth") + F.lit(1 << step)).alias("depth"),
            (F.col("gain") + F.col("more")).alias("gain"),
        ))
        if longer.isEmpty():
            break
        reached = reached.union(longer)
        higher = jumps.select(F.col("node").alias("up"), F.col("up").alias("top"), F.col("more").alias("then"))
        jumps = cut(jumps.join(higher, "up").select(
            "node", F.col("top").alias("up"), (F.col("more") + F.col("then")).alias("more")
        ))
    else:
        raise ValueError("the replies hang on a cycle")
    roots = reached.join(nodes.where("parent is null"), "node").select(
        "leaf", (F.col("gain") + F.col("score")).alias("path_score")
    )
    if best is not None:
        order = Window.partitionBy("leaf.none", "leaf.tree").orderBy(F.col("path_score").desc(), F.col("leaf.id"))
        roots = roots.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    chosen = reached.drop("gain").join(roots.select("leaf", "path_score"), "leaf")
    return chosen.join(keyed.drop("parent", "score"), "node")


def format_paths(path_rows: DataFrame) -> DataFrame:
    """One row per chosen path: tree, leaf_id, n_turns, formatted and loss_spans (start and length in code points).

    Null roles and texts are written as empty ones.
    """
    turn = F.struct(
        (-F.col("depth")).alias("at"), (F.col("role") == "assistant").alias("learn"),
        F.concat(F.lit(HEAD), escape_role(F.col("role")), F.lit("\n")).alias("head"), escape_text(F.col("text")).alias("body"),
    )
    gathered = path_rows.groupBy("leaf").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.min("tree").alias("tree")
    )
    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(TAIL)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    spans = F.aggregate("turns", start, lambda state, t: F.struct(
        (state["at"] + F.char_length(t["head"]) + F.char_length(t["body"]) + F.lit(len(TAIL))).alias("at"),
        F.when(t["learn"], F.concat(state["spans"], F.array(F.struct(
            (state["at"] + F.char_length(t["head"])).alias("start"), F.char_length(t["body"]).alias("length")
        )))).otherwise(state["spans"]).alias("spans"),
    ))
    return gathered.select(
        "tree", F.col("leaf.id").alias("leaf_id"),
        F.size("turns").cast("long").alias("n_turns"), F.array_join(pieces, "").alias("formatted"),
        spans["spans"].alias("loss_spans"),
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """Add `turns` (role, text) parsed from `formatted`, and `learned`, the text under the loss mask."""
    parts = F.filter(F.split(F.col("formatted"), TAIL, -1), lambda p: p != "")
    turns = F.transform(parts, lambda p: F.struct(
        unescape_role(F.substring_index(F.substr(p, F.lit(len(HEAD) + 1)), "\n", 1)).alias("role"),
        unescape_text(F.substr(p, F.instr(p, "\n") + 1)).alias("text"),
    ))
    learned = F.array_join(F.transform("loss_spans", lambda s: unescape_text(
        F.substr(F.col("formatted"), s["start"] + 1, s["length"])
    )), "")
    return conversations.withColumns({"turns": turns, "learned": learned})
