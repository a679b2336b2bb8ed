"""Connected components of a link table."""

from pyspark.sql import DataFrame, functions as F

from lorefield.llm.common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(node, root)``, the least node that each node can reach.

    Every node takes the least label among its neighbours and then the label of
    its label, so labels travel over doubling distances. Each round is written
    to the shared folder. Only nodes that have a link are returned; nulls and
    self links are left out. An empty table gives an empty table.
    """
    pairs = links.select("a", "b").where("a is not null and b is not null and a <> b")
    edges = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "labels")
    while True:
        heard = (edges.join(labels, edges.b == labels.node).groupBy(F.col("a").alias("node"))
                 .agg(F.min("root").alias("heard")))
        near = labels.join(heard, "node").select("node", F.col("root").alias("old"), F.least("root", "heard").alias("root"))
        above = labels.select(F.col("node").alias("up"), F.col("root").alias("top"))
        step = stored(near.join(above, near.root == above.up, "left")
                      .select("node", "old", F.coalesce(F.least("top", "root"), "root").alias("root")), "labels")
        labels = step.select("node", "root")
        if step.where("root <> old").isEmpty():
            return labels
