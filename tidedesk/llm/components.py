"""Connected components of an undirected graph, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidedesk.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` for every node of ``edges`` (``a``, ``b``); nodes share a label if a path joins them.

    In each round every node points to its least neighbour, or to itself if that is less, pointers are
    followed once more, and edges and labels are replaced by what their ends point to. Stars vanish in one
    round and paths shrink at least by half, so the rounds grow with the logarithm of the graph. Every
    round is written to the shared folder; its joins are on plain scans, so adaptive execution can split
    the node of a hot star. Loops and repeated edges do no harm.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stored(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    links = stored(both.where("a != b").distinct(), "links")
    while not links.isEmpty():
        to = stored(
            links.groupBy(F.col("a").alias("label")).agg(F.least(F.min("b"), F.first("a")).alias("p")), "pointers"
        )
        far = to.select(F.col("label").alias("p"), F.col("p").alias("pp"))
        to = stored(to.join(far, "p").select("label", F.col("pp").alias("p")), "pointers")
        labels = stored(
            labels.join(to, "label", "left").select("node", F.coalesce("p", "label").alias("label")), "labels"
        )
        ends = to.select(F.col("label").alias("b"), F.col("p").alias("q"))
        half = stored(links.join(to, F.col("a") == F.col("label")).select("p", "b").distinct(), "links")
        links = stored(half.join(ends, "b").where("p != q").select(F.col("p").alias("a"), F.col("q").alias("b")).distinct(), "links")
    return labels
