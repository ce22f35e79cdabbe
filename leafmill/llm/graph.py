"""Connected components of links between nodes, by repeated minima over neighbours and jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.plans.workdir import written


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node that has a link.

    Every round each node takes the smallest component among itself and its neighbours, and then
    that component's own; the rounds grow with the log of the longest path. A hub is harmless:
    minima are combined before they move. Each round is written to the shared folder, which cuts
    the lineage.
    """
    spark = links.sparkSession
    both = links.select(F.col(left).alias("node"), F.col(right).alias("other")).union(
        links.select(F.col(right), F.col(left))
    )
    both = written(spark, both.distinct(), "links")
    found = written(
        spark,
        both.groupBy("node")
        .agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("component")),
        "components",
    )
    while True:
        near = (
            both.join(found.select(F.col("node").alias("other"), "component"), "other")
            .groupBy("node")
            .agg(F.min("component").alias("near"))
        )
        lower = found.join(near, "node").select(
            "node", "component", F.least("component", "near").alias("lower")
        )
        jump = found.select(F.col("node").alias("lower"), F.col("component").alias("jumped"))
        fresh = written(
            spark,
            lower.join(jump, "lower").select(
                "node", F.col("component").alias("before"), F.least("lower", "jumped").alias("component")
            ),
            "components",
        )
        changed = not fresh.where("component <> before").isEmpty()
        found = fresh.select("node", "component")
        if not changed:
            return found
