"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekfold.session import settle


def components(links: DataFrame) -> DataFrame:
    """(node, component) from (a, b) links: for each linked node the smallest node it reaches.

    Every round moves each node to its smallest neighbour and contracts the
    links accordingly; only local minima remain, at most half of the nodes, so
    the rounds grow with the logarithm of the largest component. All steps
    are joins and aggregations on nodes; each round is written to the shared
    folder. Loops and repeated links are harmless; no links give no rows.
    """
    edges = settle(links.where("a <> b").select("a", "b").distinct(), "edges")
    labels = settle(
        edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        .select("node", F.col("node").alias("component")),
        "labels",
    )
    while not edges.isEmpty():
        ends = edges.select("a", "b").union(edges.select("b", "a"))
        moves = settle(
            ends.groupBy("a").agg(F.min("b").alias("least")).select(
                F.col("a").alias("from"), F.least("a", "least").alias("to")
            ),
            "moves",
        )
        labels = settle(
            labels.join(moves, labels["component"] == moves["from"], "left")
            .select("node", F.coalesce("to", "component").alias("component")),
            "labels",
        )
        to_a = moves.select(F.col("from").alias("a"), F.col("to").alias("to_a"))
        to_b = moves.select(F.col("from").alias("b"), F.col("to").alias("to_b"))
        # the link from a node to its new place becomes one from there to where that moves
        edges = settle(
            edges.join(to_a, "a").join(to_b, "b").select(
                F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")
            ).where("a <> b").distinct(),
            "edges",
        )
    return labels
