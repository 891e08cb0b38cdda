"""Connected components of a link table by contraction.

Every node points to the smallest of itself and its neighbours; pointer jumping
leads each to a root; links between roots are the next round's table.  A round
at least halves the nodes that still have links, and a node with very many links
is one row of the next round.  Every step is written to the shared folder, so
neither the lineage nor the driver holds the graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _roots(parents: DataFrame) -> DataFrame:
    """(node, label) with each label replaced by the root it leads to."""
    while True:
        of = parents.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = stored(parents.join(of, "label").select("node", F.col("next").alias("label"),
                                                       (F.col("next") < F.col("label")).alias("changed")), "component-roots")
        parents = step.select("node", "label")
        if step.where("changed").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b); label is the smallest node of the component."""
    edges = stored(links.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low < high").distinct(),
                   "component-edges")
    labels = None
    while True:
        near = (edges.select(F.col("low").alias("node"), F.col("high").alias("other")).union(edges.select("high", "low"))
                .groupBy("node").agg(F.min("other").alias("other")))
        roots = _roots(stored(near.select("node", F.least("node", "other").alias("label")), "component-parents"))
        if labels is None:
            labels = roots
        else:
            of = roots.select(F.col("node").alias("label"), F.col("label").alias("root"))
            labels = stored(labels.join(of, "label", "left").select("node", F.coalesce("root", "label").alias("label")),
                            "component-labels")
        edges = stored(
            edges.join(roots.select(F.col("node").alias("low"), F.col("label").alias("x")), "low")
            .join(roots.select(F.col("node").alias("high"), F.col("label").alias("y")), "high")
            .select(F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high")).where("low < high").distinct(), "component-edges")
        if edges.isEmpty():
            return labels
