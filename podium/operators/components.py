"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.session import durable


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node of ``edges``; a component is named by its least node.

    Each round a node takes the least label among its neighbours and itself and
    then its label's label, so a chain of n nodes settles in about log n rounds.
    Labels are checkpointed each round: lineage stays short and a lost executor
    costs no more than a round.  The aggregation to the least label combines
    before the shuffle, so a hub with many edges is no hot key.  Edges with a
    null end are left out; an empty table gives an empty result.  Raises if
    labels have not settled after ``rounds`` rounds.
    """
    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    both = durable(ends.union(ends.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = durable(both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("l")))
    for _ in range(rounds):
        near = both.join(labels.select(F.col("u").alias("v"), F.col("l").alias("m")), "v").groupBy("u").agg(F.min("m").alias("m"))
        step = labels.join(near, "u").select("u", F.col("l").alias("old"), F.least("l", "m").alias("l"))
        jump = labels.select(F.col("u").alias("l"), F.col("l").alias("up"))
        new = durable(step.join(jump, "l", "left").select("u", "old", F.least("l", "up").alias("l")))
        changed = new.where("old <> l").limit(1).count()
        labels = new.select("u", "l")
        if not changed:
            return labels.select(F.col("u").alias("node"), F.col("l").alias("component"))
    raise RuntimeError(f"components have not settled after {rounds} rounds")
