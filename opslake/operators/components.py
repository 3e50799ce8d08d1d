"""Connected components by smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.sources.scratch import written


def components(nodes: DataFrame, links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id that links reach, for each id of nodes.

    nodes: (id), distinct. links: (a, b) between ids. A round takes each id's smallest neighbouring label and then that label's own label, so
    that chains halve; labels of links are min-aggregated before they are shuffled. Raises RuntimeError if rounds don't suffice.
    """
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = written(nodes.select("id", F.col("id").alias("component")), "labels")
    for _ in range(rounds):
        near = both.join(label.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        step = label.join(near, "id", "left").select("id", F.col("component").alias("was"), F.least("component", "near").alias("next"))
        root = label.select(F.col("id").alias("next"), F.col("component").alias("root"))
        new = written(step.join(root, "next", "left").select("id", "was", F.least("next", "root").alias("component")), "labels")
        changed = new.where("component <> was").limit(1).count()
        label = new.select("id", "component")
        if not changed:
            return label
    raise RuntimeError(f"components did not settle in {rounds} rounds")
