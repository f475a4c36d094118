"""Connected components as DataFrame steps: every node hooks to its least neighbour, and the graph is contracted.

Every step is a join or a grouped minimum over staged tables, so a node with very many edges is split by Spark's skew
handling on the join side and combined before the shuffle on the grouping side. Each round leaves at most half of the
nodes, so rounds are few and later ones small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterdw.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """node, label for every node of the edges (a, b): the least node it is connected to. No edges, no rows."""
    def apart(rows, a, b):
        ends = rows.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        return staged(ends.distinct(), "edges")

    left, rounds = apart(edges, "a", "b"), []
    while not rounds or not left.isEmpty():
        both = left.union(left.select("b", "a")).toDF("node", "other")
        hooks = staged(both.groupBy("node").agg(F.least("node", F.min("other")).alias("up")), "hooks")
        jumped = hooks.join(hooks.toDF("up", "label"), "up").select("node", "label")
        rounds.append(jumped)
        left = apart(left.join(jumped.toDF("a", "label_a"), "a").join(jumped.toDF("b", "label_b"), "b"),
                     "label_a", "label_b")
    labels = rounds[0]
    for later in rounds[1:]:
        labels = labels.join(later.toDF("label", "root"), "label", "left").select(
            "node", F.coalesce("root", "label").alias("label"))
    return staged(labels, "labels")
