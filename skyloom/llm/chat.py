"""Reply trees as conversations.

Messages name their parent. Self-joins by pointer doubling (distance 1, 2, 4, ...) sum the scores from every leaf to
its root and list each chosen path, in a number of joins that is the logarithm of the depth. A path becomes one
conversation: turns in a template whose marks cannot occur in texts, with the spans that count for the loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import lasting, saved, scratch

OPEN, SEAL, CLOSE = "<turn:", ">\n", "\n</turn>\n"
_TURN = r"<turn:([^>]*)>\n([^<]*)\n</turn>\n"


def hide(text: Column) -> Column:
    """text without '<' and '>', which only the template's own marks hold; show() gives it back."""
    for plain, hidden in (("\\", "\\\\"), ("<", "\\("), (">", "\\)")):
        text = F.replace(text, F.lit(plain), F.lit(hidden))
    return text


def show(text: Column) -> Column:
    """What hide() has hidden. Between hidden backslashes a single one begins a hidden mark."""
    parts = F.split(text, r"\\\\")
    return F.array_join(F.transform(parts, lambda x: F.replace(F.replace(x, F.lit("\\("), F.lit("<")), F.lit("\\)"), F.lit(">"))), "\\")


def linear(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations as trees of one branch: each row answers the one before it, by turn.

    Equal turns follow by role, then text, nulls first; repeated rows stay separate turns. Texts of any length stay whole,
    other columns are not looked at, and an empty table gives no rows.
    """
    order = W.partitionBy(conversation).orderBy(turn, role, text)
    return turns.select(
        F.col(conversation).alias("tree_id"), (at := F.row_number().over(order).cast("long")).alias("msg_id"), F.when(at > 1, at - 1).alias("parent_id"),
        F.col(role).alias("role"), F.col(text).alias("text"), F.lit(0.0).alias("score"),
    )


def paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """Root-to-leaf paths: (tree_id, leaf_id, path_rank, score, pos, role, text), one row for each message of a path.

    messages: tree_id, msg_id, parent_id, role, text, score. A path's score is the sum of its messages' scores (null: 0);
    path_rank is 1 for the best of its tree, ties to the smaller leaf; `best` keeps so many of each tree.
    A message without a known parent is a root. Of repeated msg_ids in a tree the least (parent_id, role, text) stays.
    Messages that answer each other in a circle have no root and are left out. No rows give no rows. Texts of any length
    stay whole, and other columns are not looked at.
    """
    with scratch(messages.sparkSession):
        return lasting(_paths(messages, best), "paths")


def _paths(messages: DataFrame, best: int | None) -> DataFrame:
    fields = F.struct("parent_id", "role", "text", F.coalesce("score", F.lit(0.0)).alias("score"))
    nodes = saved(messages.where("msg_id is not null").groupBy("tree_id", "msg_id").agg(F.min(fields).alias("m")).select("tree_id", "msg_id", "m.*"), "nodes")
    key = nodes.select(F.col("tree_id").alias("t"), F.col("msg_id").alias("p"))
    up = nodes.join(key, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("parent_id") == F.col("p")), "left")
    jump = saved(up.select("tree_id", "msg_id", F.col("p").alias("above"), "score", F.lit(1).cast("long").alias("n")), "jump")
    levels, most = [jump], max(1, nodes.count())
    while jump.where("above is not null").limit(1).count() and 2 ** len(levels) <= 2 * most:
        a, b = jump.where("above is not null").alias("a"), jump.alias("b")  # what has reached its root is not joined again
        on = F.col("a.tree_id").eqNullSafe(F.col("b.tree_id")) & (F.col("a.above") == F.col("b.msg_id"))
        further = a.join(b, on, "left").select("a.tree_id", "a.msg_id", F.col("b.above").alias("above"), (F.col("a.score") + F.coalesce("b.score", F.lit(0.0))).alias("score"), (F.col("a.n") + F.coalesce("b.n", F.lit(0))).alias("n"))
        jump = saved(jump.where("above is null").unionByName(further), "jump")
        levels.append(jump)
    parents = nodes.where("parent_id is not null").select(F.col("tree_id").alias("t"), F.col("parent_id").alias("p")).distinct()
    leaves = jump.where("above is null").join(parents, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("msg_id") == F.col("p")), "left_anti")
    ranked = leaves.withColumn("path_rank", F.row_number().over(W.partitionBy("tree_id").orderBy(F.desc("score"), "msg_id")))
    ranked = ranked if best is None else ranked.where(F.col("path_rank") <= best)
    found = saved(ranked.select("tree_id", F.col("msg_id").alias("leaf_id"), "path_rank", "score", (F.col("n") - 1).alias("pos"), "msg_id"), "paths")
    for level, step in enumerate(levels):
        s = step.where("above is not null").select(F.col("tree_id").alias("t"), F.col("msg_id").alias("m"), "above")
        more = found.join(s, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("msg_id") == F.col("m")))
        more = more.select("tree_id", "leaf_id", "path_rank", found["score"], (F.col("pos") - 2**level).alias("pos"), F.col("above").alias("msg_id"))
        found = saved(found.unionByName(more), "paths") if level < len(levels) - 1 else found
    body = nodes.select(F.col("tree_id").alias("t"), F.col("msg_id").alias("m"), "role", "text")
    return found.join(body, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("msg_id") == F.col("m"))).select("tree_id", "leaf_id", "path_rank", "score", "pos", "role", "text")


def conversations(messages: DataFrame, best: int | None = 1, learn_from: str = "assistant") -> DataFrame:
    """One row for each chosen path: tree_id, leaf_id, path_rank, score, formatted, loss (spans of code points).

    Null roles and texts count as empty, and texts of any length are taken whole. The loss spans hold the escaped texts of
    `learn_from` turns, without marks. Columns of messages but those of paths() are not looked at. No rows give no rows.
    """
    text = lambda c: F.coalesce(c, F.lit(""))
    rows = paths(messages, best).withColumns({"_head": F.concat(F.lit(OPEN), hide(text("role")), F.lit(SEAL)), "_body": hide(text("text"))})
    rows = rows.withColumn("_long", (F.length("_head") + F.length("_body") + len(CLOSE)).cast("long"))
    order = W.partitionBy("tree_id", "leaf_id", "path_rank", "score").orderBy("pos")
    start = F.sum("_long").over(order) - F.col("_long") + F.length("_head")
    span = F.when(F.col("role") == learn_from, F.struct(start.alias("start"), (start + F.length("_body")).alias("stop")))
    turn = F.struct("pos", F.concat("_head", "_body", F.lit(CLOSE)).alias("shown"), "_span")
    made = rows.withColumn("_span", span).groupBy("tree_id", "leaf_id", "path_rank", "score").agg(F.array_sort(F.collect_list(turn)).alias("_turns"))
    loss = F.filter(F.transform("_turns", lambda t: t["_span"]), lambda x: x.isNotNull())
    return made.select("tree_id", "leaf_id", "path_rank", "score", F.array_join(F.transform("_turns", lambda t: t["shown"]), "").alias("formatted"), loss.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns and the learnt texts of formatted conversations: adds turns array<struct<role,text>>, learnt array<string>.

    Columns of these names give way, others stay. A null or empty conversation has no turns, or none that is known; texts of
    any length come back whole, repeated rows alike, and an empty table stays empty.
    """
    part = lambda i: F.transform(F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(i)), show)
    turns = F.transform(F.arrays_zip(part(1).alias("role"), part(2).alias("text")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    learnt = F.transform("loss", lambda x: show(F.substring("formatted", (x["start"] + 1).cast("int"), (x["stop"] - x["start"]).cast("int"))))
    return formatted.withColumns({"turns": turns, "learnt": learnt})
