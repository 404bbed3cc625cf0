"""Connected components of links, by rounds of smallest labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b): root is the smallest node it can reach.

    A round gives each node the smallest label among its own and its neighbours', then the label of
    that label's node, so a chain of n links takes some log2(n) rounds. Labels are aggregated map
    side, so a node with very many links is no single task's work. Each round is checkpointed. No
    links give no rows.
    """
    both = cut_lineage(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b")
        .distinct()
    )
    labels = cut_lineage(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("root")
        )
    )
    while True:
        told = both.join(labels, both["a"] == labels["node"]).select(F.col("b").alias("node"), "root")
        least = labels.select("node", "root").union(told).groupBy("node").agg(F.min("root").alias("root"))
        above = labels.select(F.col("node").alias("root"), F.col("root").alias("above"))
        before = labels.select("node", F.col("root").alias("before"))
        new = cut_lineage(
            least.join(above, "root", "left")
            .select("node", F.least("root", F.coalesce("above", "root")).alias("root"))
            .join(before, "node")
        )
        labels = new.select("node", "root")
        if new.where("root <> before").isEmpty():
            return labels
