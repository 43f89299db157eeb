"""Connected components of a graph given as edges, in rounds of joins.

Each round every node takes the smallest label of its neighbours and then the
label of its label, so that a path of n edges needs about log n rounds. Rounds
are written to the shared folder; edges and labels are read from there, so both
sides of a join are plain exchanges that adaptive execution can split where one
node has very many edges. Nothing but the number of changes reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def components(work: Workspace, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) of every node with an edge; the label is the smallest node of its component.

    ``edges``: columns a and b, long. Repeated edges and loops do no harm.
    """
    both = work.keep(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = work.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    for _ in range(most_rounds):
        offered = both.join(labels, both["a"] == labels["node"]).select(both["b"].alias("node"), "label", F.lit(False).alias("own"))
        own = labels.select("node", "label", F.lit(True).alias("own"))
        spread = work.keep(
            offered.unionByName(own).groupBy("node").agg(F.min("label").alias("label"), F.min(F.when(F.col("own"), F.col("label"))).alias("old")),
            "spread",
        )
        up = spread.select(F.col("node").alias("up"), F.col("label").alias("top"))
        jumped = work.keep(spread.join(up, spread["label"] == up["up"], "left").select("node", F.least("label", "top").alias("label"), "old"), "jumped")
        changed = jumped.where(F.col("label") != F.col("old")).limit(1).count()
        work.drop(labels, spread)
        labels = jumped.select("node", "label")
        labels._rg_path = jumped._rg_path
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    work.drop(both)
    return labels
