"""Connected components of a distributed edge list."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.shared import stored


def _roots(parents: DataFrame) -> DataFrame:
    """Follow ``node -> parent`` to the end. Parents are smaller, so there is one."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        joined = parents.join(up, "parent", "left")
        parents = stored(
            joined.select(
                "node",
                F.coalesce("above", "parent").alias("parent"),
                F.col("above").isNotNull().alias("moved"),
            ),
            "roots",
        )
        if parents.filter("moved").isEmpty():
            return parents.drop("moved")
        parents = parents.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``; the smallest node names it.

    Each round hooks every node to its smallest neighbour if that is smaller, shortens the chains
    to their roots, and contracts the edges to edges between roots. Only the minimum of a node's
    neighbours is kept, in map-side partial aggregates, so a node with very many neighbours is
    never gathered. The number of rounds is logarithmic in practice. Rows with a null end or with
    equal ends are left out; repeated edges do no harm.
    """
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        hooked = lowest.select("node", F.least("node", "low").alias("parent"))
        if labels is not None and edges.isEmpty():
            return labels
        moving = stored(hooked.filter("parent < node"), "hooks")
        roots = _roots(moving)
        if labels is None:
            labels = lowest.select("node").join(roots, "node", "left")
            labels = labels.select("node", F.coalesce("parent", "node").alias("component"))
        else:
            up = roots.select(F.col("node").alias("component"), "parent")
            labels = labels.join(up, "component", "left")
            labels = labels.select("node", F.coalesce("parent", "component").alias("component"))
        labels = stored(labels, "labels")
        for end in ("a", "b"):
            up = roots.select(F.col("node").alias(end), "parent")
            edges = edges.join(up, end, "left")
            edges = edges.withColumn(end, F.coalesce("parent", end)).drop("parent")
        edges = stored(edges.filter("a <> b").distinct(), "edges")
