"""Conversations from reply trees, in Spark's own expressions throughout.

Messages name the message they reply to. Self-joins double the reach of each message's pointer until all
end at a root, adding up lengths and scores on the way: a path of n messages takes log n rounds. Every
leaf is then a branch with a score, the mean of its messages'; the best branches of each tree are chosen
before any path is written out. Their paths are enumerated by the same pointers, downwards: a stretch of
2**k messages is cut in two by the pointer over half of it. Only chosen paths meet their texts.

A path is one conversation, each turn between control strings of its role (other roles than the three
known ones are named). A control string inside a text gets a backslash behind its first character, or one
more if it has some, so the marks stay the only ones and the text can be read back. The loss mask is the
list of stretches, in code points, that hold assistants' texts.

Null texts and roles are empty, null or NaN scores are 0. A message whose parent does not exist is a root.
Messages with one id in one tree count once (the least of their rows). Messages without an id are left
out, as are those that reply to each other in a circle or hang under one: no root leads there. A null tree
is a tree of its own. Equal scores: the smaller leaf. An empty table gives no rows; other columns are
ignored. A conversation is one value, so it must fit in one; nothing else is gathered by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulo.llm.common import stage

SYSTEM, USER, ASSISTANT = "system", "user", "assistant"
MARKS = {SYSTEM: ("[SYS]", "[/SYS]"), USER: ("[INST]", "[/INST]"), ASSISTANT: ("<s>", "</s>")}
# Other roles: the name stands between the first two.
NAMED = ("[ROLE]", "[/ROLE]", "[END]")
_TAILS = r"/?s>", r"(?:/?SYS|/?INST|/?ROLE|END)\]"
_PLAIN = rf"(<(?=\\*{_TAILS[0]})|\[(?=\\*{_TAILS[1]}))"
_ESCAPED = rf"(<(?=\\+{_TAILS[0]})|\[(?=\\+{_TAILS[1]}))\\"
_TURN = r"(?=<s>|\[SYS\]|\[INST\]|\[ROLE\])"


# ---- template ------------------------------------------------------------------------------------


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def opening(role: Column) -> Column:
    named = F.concat(F.lit(NAMED[0]), escape(role), F.lit(NAMED[1]))
    return _by_role(role, lambda marks: F.lit(marks[0]), named)


def closing(role: Column) -> Column:
    return _by_role(role, lambda marks: F.lit(marks[1]), F.lit(NAMED[2]))


def _by_role(role: Column, known, other: Column) -> Column:
    for name, marks in MARKS.items():
        other = F.when(role == name, known(marks)).otherwise(other)
    return other


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of ``role`` and ``text``."""

    def turn(piece: Column) -> Column:
        rest = F.substring(piece, F.lit(len(NAMED[0]) + 1), F.length(piece))
        role = F.substring_index(rest, NAMED[1], 1)
        text = _between(rest, F.length(role) + len(NAMED[1]), F.lit(len(NAMED[2])))
        out = F.struct(unescape(role).alias("role"), unescape(text).alias("text"))
        for name, (start, stop) in MARKS.items():
            text = _between(piece, F.lit(len(start)), F.lit(len(stop)))
            known = F.struct(F.lit(name).alias("role"), unescape(text).alias("text"))
            out = F.when(piece.startswith(start), known).otherwise(out)
        return out

    return F.transform(F.split(formatted, _TURN), turn)


def _between(text: Column, before: Column, after: Column) -> Column:
    return F.substring(text, before + 1, F.length(text) - before - after)


def read_masked(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, one after the other."""
    parts = F.transform(
        loss, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, (s["stop"] - s["start"]).cast("int")))
    )
    return F.array_join(parts, "")


# ---- trees ---------------------------------------------------------------------------------------


def chains(rows: DataFrame) -> DataFrame:
    """Conversations of ``conv_id``, ``turn``, ``role``, ``text`` as trees with one branch: each row replies
    to the one before it, by turn (equal turns: by role and text)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node_id"))
    parent = F.when(F.col("node_id") > 1, F.col("node_id") - 1)
    return numbered.select(
        F.col("conv_id").alias("tree_id"), "node_id", parent.alias("parent_id"), "role", "text", F.lit(0.0).alias("score")
    )


def pointers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Per k, the messages (``tree``, ``node``) with ``up``, the message 2**k above; and for every message
    under a root ``length`` and ``total`` (score) of its path.

    ``nodes``: unique ``tree``, ``node``, ``parent`` and ``score``."""
    own = nodes.select("tree", F.col("node").alias("parent"), F.col("parent").alias("above"))
    state = nodes.join(own.select("tree", "parent", F.lit(True).alias("known")), ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("length"), F.col("score").alias("total")
    )
    state, jumps = stage(state, "replies"), []
    most = state.count()
    # Messages whose path has ended leave the rounds; others still look them up.
    ended, open_ = state.where("up IS NULL"), state.where("up IS NOT NULL")
    while not open_.isEmpty() and 1 << len(jumps) <= most:
        jumps.append(open_.select("tree", "node", "up"))
        above = ended.unionByName(open_).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("further"), F.col("length").alias("more"), F.col("total").alias("sum")
        )
        state = open_.join(above, ["tree", "up"]).select(
            "tree",
            "node",
            F.col("further").alias("up"),
            (F.col("length") + F.col("more")).alias("length"),
            (F.col("total") + F.col("sum")).alias("total"),
        )
        state = stage(state, "replies")
        ended, open_ = ended.unionByName(state.where("up IS NULL")), state.where("up IS NOT NULL")
    return jumps, ended.drop("up")


def branches(nodes: DataFrame, reach: DataFrame, most: int) -> DataFrame:
    """The best leaves of each tree: ``tree``, ``branch`` (from 1), ``leaf``, ``length``, ``score``."""
    parents = nodes.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    leaves = reach.join(parents, ["tree", "node"], "left_anti")
    leaves = leaves.select("tree", F.col("node").alias("leaf"), "length", (F.col("total") / F.col("length")).alias("score"))
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    return leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= most)


def paths(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """Every message of every chosen branch: ``tree``, ``branch``, ``leaf``, ``node``, ``place`` (root: 0)."""
    out = chosen.select("tree", "branch", "leaf", "length", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("below"))
    for k in reversed(range(len(jumps))):
        halves = F.array(
            F.struct(F.col("node").alias("node"), F.col("below").alias("below")),
            F.struct(F.col("up").alias("node"), (F.col("below") + (1 << k)).alias("below")),
        )
        out = out.join(jumps[k], ["tree", "node"], "left").select("tree", "branch", "leaf", "length", F.explode(halves).alias("half"))
        out = out.where("half.node IS NOT NULL").select("tree", "branch", "leaf", "length", "half.node", "half.below")
    return out.select("tree", "branch", "leaf", "node", (F.col("length") - F.col("below") - 1).alias("place"))


def conversations(messages: DataFrame, most: int = 1) -> DataFrame:
    """The ``most`` best branches of each tree of ``tree_id``, ``node_id``, ``parent_id``, ``role``, ``text``,
    ``score``, formatted: ``tree_id``, ``branch`` (from 1), ``leaf_id``, ``score``, ``n_turns``, ``formatted``
    and ``loss``, an array of ``start`` and ``stop``."""
    score = F.coalesce(F.nanvl(F.col("score").cast("double"), F.lit(0.0)), F.lit(0.0))
    # A struct around the tree's id makes null a value like any other.
    rows = messages.where("node_id IS NOT NULL").groupBy(F.struct(F.col("tree_id").alias("id")).alias("tree"), F.col("node_id").alias("node")).agg(
        F.min(
            F.struct(
                F.col("parent_id").alias("parent"),
                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                score.alias("score"),
            )
        ).alias("m")
    )
    rows = stage(rows.select("tree", "node", "m.*"), "messages")
    nodes = rows.select("tree", "node", "parent", "score")
    jumps, reach = pointers(nodes)
    chosen = stage(branches(nodes, reach, most), "branches")
    turns = paths(chosen, jumps).join(rows.select("tree", "node", "role", "text"), ["tree", "node"])
    turns = turns.select(
        "tree",
        "branch",
        "place",
        opening(F.col("role")).alias("before"),
        escape(F.col("text")).alias("said"),
        closing(F.col("role")).alias("after"),
        (F.col("role") == ASSISTANT).alias("learned"),
    )
    path = Window.partitionBy("tree", "branch").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.concat("before", "said", "after")
    start = F.coalesce(F.sum(F.length(whole)).over(path), F.lit(0)) + F.length("before")
    turns = turns.withColumn("start", start).withColumn("stop", F.col("start") + F.length("said"))
    parts = F.array_sort(F.collect_list(F.struct("place", "start", "stop", "learned", whole.alias("piece"))))
    joined = turns.groupBy("tree", "branch").agg(parts.alias("parts"))
    spans = F.transform(F.filter("parts", lambda p: p["learned"]), lambda p: F.struct(p["start"].alias("start"), p["stop"].alias("stop")))
    return joined.join(chosen, ["tree", "branch"]).select(
        F.col("tree.id").alias("tree_id"),
        "branch",
        F.col("leaf").alias("leaf_id"),
        "score",
        F.size("parts").cast("long").alias("n_turns"),
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"),
        spans.alias("loss"),
    )
