"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.sources.scratch import stored

MAX_ROUNDS = 60


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for links(a, b): component is the least node that a node is linked with, over any number of links.

    A round points each node at the least node it is linked with, follows the pointers two steps on, and
    puts the pointed-at nodes in place of both ends of every link; links within a group vanish. So the link
    table shrinks by at least half its nodes a round. No links give no rows; links to itself and repeated
    links do no harm.
    """
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    labels: DataFrame | None = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("near", "node").alias("parent"))
        for _ in range(2):
            parents = stored(parents, "parents")
            onward = parents.select(F.col("node").alias("parent"), F.col("parent").alias("far"))
            parents = parents.join(onward, "parent").select("node", F.col("far").alias("parent"))
        parents = stored(parents, "parents")
        if labels is None:
            labels = parents.withColumnRenamed("parent", "component")
        else:
            onward = parents.select(F.col("node").alias("component"), "parent")
            labels = labels.join(onward, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
        labels = stored(labels, "labels")
        a_end, b_end = parents.select(F.col("node").alias("a"), F.col("parent").alias("x")), parents.select(F.col("node").alias("b"), F.col("parent").alias("y"))
        moved = edges.join(a_end, "a").join(b_end, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = stored(moved.distinct(), "edges")
        if not edges.head(1):
            return labels
    raise RuntimeError("components have not settled; raise MAX_ROUNDS")
