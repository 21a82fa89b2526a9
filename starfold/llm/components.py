"""Connected components of a graph whose links lie in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starfold.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); a component is named by its least node.

    Each pass takes the least name among a node and its neighbours, then the name of that name, so long paths
    shrink by half. Passes are written to the shared folder. A node with very many links is reduced before the
    shuffle, and its join can be split.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").distinct(), "links")
    names = stored(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("component")), "names")
    while True:
        near = (
            both.join(names.select(F.col("node").alias("other"), "component"), "other")
            .groupBy("node")
            .agg(F.min("component").alias("near"))
        )
        least = names.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("name")
        )
        onward = names.select(F.col("node").alias("name"), F.col("component").alias("onward"))
        new = stored(
            least.join(onward, "name").select("node", "before", F.least("name", "onward").alias("component")), "names"
        )
        names = new.select("node", "component")
        if new.filter("before != component").isEmpty():
            return names
