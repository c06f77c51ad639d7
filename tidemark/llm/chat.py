"""Chat formatting of reply trees.

A message names its parent; a path from a root to a leaf is a conversation. Ancestors are found by
self-joins that double the distance each time, so a chain of n messages takes log2(n) joins, and every
node learns its path's score on the way. Branches are ranked within their tree by that score. The same
tables of ancestors, from the longest distance to the shortest, then give all nodes of the chosen paths.

Template: ``<s>text</s>`` for an assistant, ``[INST] role newline text [/INST]`` for anyone else. In
texts and roles a backslash goes before every backslash and every control string (in a role, also
before a line break), so the turns can be read back exactly.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.llm.tables import stored

ASSISTANT = "assistant"
BRANCHES = 1
ROUNDS = 40
CONTROL = r"<s>|</s>|\[INST\]|\[/INST\]"
_MARK = re.compile(r"\\(?:.)|(<s>|</s>|\[INST\] | \[/INST\])", re.DOTALL)


def escaped(text: Column, also: str = "") -> Column:
    return F.regexp_replace(text, rf"(\\|{CONTROL}{also})", r"\\$1")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def paths(nodes: DataFrame, branches: int | None = BRANCHES) -> DataFrame:
    """Nodes of the chosen branches: tree, leaf, branch (rank from 1), position (from 0), and the node's own columns.

    ``nodes`` has tree (null: a tree like any other), node (unique in its tree), parent and score. A branch's score is the sum of its
    nodes' (null: 0); the ``branches`` best of a tree are chosen (None: all), equal ones by smaller leaf.
    A node whose parent is not in its tree is a root. Nodes that only lead back to themselves have no
    root and are on no path.
    """
    # Joins drop null keys, so a tree goes by whether it is null and a value that isn't.
    kind = nodes.schema["tree"].dataType
    blank = F.lit("" if isinstance(kind, StringType) else 0).cast(kind)
    nodes = nodes.withColumn("tree", F.struct(F.col("tree").isNull().alias("no"), F.coalesce("tree", blank).alias("id")))
    own = nodes.select("tree", "node", F.col("parent").alias("up"), F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    real = nodes.select("tree", F.col("node").alias("up")).withColumn("is_real", F.lit(True))
    own = own.join(real, ["tree", "up"], "left").withColumn("up", F.when(F.col("is_real"), F.col("up")))
    jumps = [stored(own.select("tree", "node", "up", F.lit(1).cast("long").alias("depth"), "score"), "jumps")]
    for _ in range(ROUNDS):
        if not jumps[-1].where("up is not null").limit(1).count():
            break
        last = jumps[-1]
        far = last.select("tree", F.col("node").alias("up"), F.col("up").alias("far"), F.col("depth").alias("more"), F.col("score").alias("add"))
        # Only nodes that haven't reached their root are joined; the others are done.
        joined = last.where("up is not null").join(far, ["tree", "up"])
        doubled = joined.select(
            "tree", "node", F.col("far").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("score") + F.col("add")).alias("score")
        )
        jumps.append(stored(last.where("up is null").union(doubled.select(*last.columns)), "jumps"))
        if len(jumps) > 2 and jumps[-1].where("up is not null").count() == jumps[-2].where("up is not null").count():
            break  # what is left runs in circles
    whole = jumps[-1].where("up is null")
    parents = jumps[0].where("up is not null").select("tree", F.col("up").alias("node")).distinct()
    leaves = whole.join(parents, ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(order))
    if branches is not None:
        chosen = chosen.where(F.col("branch") <= branches)
    members = chosen.select("tree", F.col("node").alias("leaf"), "branch", "node")
    for jump in reversed(jumps):
        step = members.join(jump.where("up is not null").select("tree", "node", "up"), ["tree", "node"])
        members = stored(members.union(step.select("tree", "leaf", "branch", F.col("up").alias("node"))), "members")
    places = whole.select("tree", "node", (F.col("depth") - 1).alias("position"))
    found = members.join(places, ["tree", "node"]).join(nodes, ["tree", "node"])
    return found.withColumn("tree", F.when(~F.col("tree.no"), F.col("tree.id")))


KEY = ["tree", "leaf", "branch"]


def ranged(rows: DataFrame, group: list[str], order: list[str], length: Column) -> DataFrame:
    """``rows`` with nth, from 0, and start, the sum of the lengths before, in their group by ``order`` (nulls first).

    Groups are cut by range of their order, so a large one is spread over many tasks; what each range holds of a group is added up.
    """
    dealt = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    dealt = stored(dealt.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33)), "ranges")
    dealt = dealt.withColumn("_length", length.cast("long"))
    held = dealt.groupBy(*group, "_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"), F.sum("_length").alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    for name in ("_n", "_sum"):
        held = held.withColumn(f"{name}_before", F.coalesce(F.sum(name).over(earlier), F.lit(0)))
    held = held.select(*(F.col(c).alias(f"_{c}") for c in group), F.col("_part").alias("__part"), "_first", "_n_before", "_sum_before")
    same = F.col("_part") == F.col("__part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = dealt.join(held, same)
    within = Window.partitionBy(*group, "_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    nth, start = F.col("_n_before") + F.col("_id") - F.col("_first"), F.col("_sum_before") + F.coalesce(F.sum("_length").over(within), F.lit(0))
    return joined.select(*rows.columns, nth.alias("nth"), start.alias("start"))


def pieces(turns: DataFrame) -> DataFrame:
    """One row per turn: tree, leaf, branch, position, piece (its text as formatted), is_loss, nth and start, its first code point.

    ``turns`` has tree, leaf, branch, position, role and text; null role or text: empty.
    """
    is_loss = F.coalesce(F.col("role"), F.lit("")) == ASSISTANT
    words = escaped(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit("[INST] "), escaped(F.coalesce("role", F.lit("")), r"|\n"), F.lit("\n"))
    piece = F.when(is_loss, F.concat(F.lit("<s>"), words, F.lit("</s>"))).otherwise(F.concat(head, words, F.lit(" [/INST]")))
    made = turns.select(*KEY, "position", is_loss.alias("is_loss"), piece.alias("piece"))
    return ranged(made, KEY, ["position"], F.length("piece"))


def formatted(turns: DataFrame) -> DataFrame:
    """One row per conversation: tree, leaf, branch, n_turns, text, and loss: the spans (start, end) of the assistants' words in it.

    For ``turns`` see ``pieces``. Spans count code points. Here a conversation is one text in one row; one
    that is too long for a row is read from its pieces.
    """
    made = pieces(turns)
    gathered = made.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("position", "piece", "is_loss", "start"))).alias("items"))
    spans = F.transform(
        F.filter("items", lambda x: x["is_loss"]),
        lambda x: F.struct(
            (x["start"] + len("<s>")).alias("start"),
            (x["start"] + F.length(x["piece"]) - len("</s>")).alias("end"),
        ),
    )
    text = F.array_join(F.transform("items", lambda x: x["piece"]), "")
    return gathered.select(*KEY, F.size("items").cast("long").alias("n_turns"), text.alias("text"), spans.alias("loss"))


def read_turns(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted conversation."""
    found, opened = [], None
    for mark in _MARK.finditer(text):
        if mark[1] in ("<s>", "[INST] "):
            opened = mark.end()
        elif mark[1] == "</s>":
            found.append((ASSISTANT, unescape(text[opened : mark.start()])))
        elif mark[1]:
            role, words = re.match(r"((?:[^\\\n]|\\.)*)\n(.*)", text[opened : mark.start()], re.DOTALL).groups()
            found.append((unescape(role), unescape(words)))
    return found


def chain(turns: DataFrame) -> DataFrame:
    """Reply trees of one branch from rows by turn (conv_id, turn, role, text): each row answers the one before.

    Rows of the same conversation and turn, repeated ones too, follow each other by role and text. Rows
    without a conv_id are one conversation of their own; a null turn comes first.
    """
    named = turns.select(F.col("conv_id").cast("long").alias("tree"), F.col("turn").cast("long").alias("turn"), "role", "text")
    numbered = ranged(named, ["tree"], ["turn", "role", "text"], F.lit(0)).withColumn("node", F.col("nth") + 1)
    return numbered.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")
