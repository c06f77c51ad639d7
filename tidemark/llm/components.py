"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for every node in ``links`` (a, b). Links from a node to itself say nothing.

    Each round every node goes over to one of itself and its neighbours, the first in an order drawn anew
    for the round, and the links are redrawn between those; a good part of the nodes goes each time,
    whatever the shape. Each round is written to the shared folder, which cuts the lineage, and so is
    where the moves so far, one after the other, have taken each node.
    """
    edges = stored(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels: DataFrame | None = None
    rounds = 0
    while edges.limit(1).count():
        if rounds == ROUNDS:
            raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
        pairs = [F.struct(F.col(x).alias("node"), F.col(y).alias("to")) for x, y in ("ab", "ba", "aa", "bb")]
        near = edges.select(F.inline(F.array(*pairs)))
        first = F.min_by("to", F.xxhash64("to", F.lit(rounds))).alias("label")
        moves = stored(near.groupBy("node").agg(first), "moves")
        to = {name: moves.select(F.col("node").alias(name), F.col("label").alias(f"to_{name}")) for name in ("a", "b")}
        redrawn = edges.join(to["a"], "a").join(to["b"], "b").where("to_a != to_b")
        redrawn = redrawn.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        edges = stored(redrawn.distinct(), "edges")
        if labels is None:
            labels = moves
        else:  # nodes that have settled have no links left, and no move
            further = moves.select(F.col("node").alias("label"), F.col("label").alias("further"))
            labels = stored(labels.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label")), "labels")
        rounds += 1
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0)
    least = labels.groupBy("label").agg(F.min("node").alias("least"))
    return labels.join(least, "label").select("node", F.col("least").alias("label"))
