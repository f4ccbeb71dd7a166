"""Connected components of a graph given by its links, without gathering anything on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import release, store


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in links (a, b); the component is its smallest id.

    Each round a vertex takes the smallest label among its neighbours and then the label of that
    label, so paths shorten by half; a hub costs one row a task, since minima are combined before
    the shuffle. Rounds are stored tables, of which one is kept.
    """
    spark = links.sparkSession
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges, edges_path = store(both.where("a <> b").distinct(), "links")
    labels = edges.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("id"), F.least("a", "b").alias("component")
    )
    labels, path = store(labels, "labels")
    while True:
        near = (
            edges.join(labels, edges.b == labels.id)
            .groupBy("a").agg(F.min("component").alias("least"))
        )
        known = labels.join(near, labels.id == near.a).select(
            "id", F.col("component").alias("old"), F.least("component", "least").alias("step")
        )
        jump = labels.select(F.col("id").alias("step"), F.col("component").alias("far"))
        moved = known.join(jump, "step", "left").select(
            "id", "old", F.least("step", F.coalesce("far", "step")).alias("component")
        )
        labels, new_path = store(moved, "labels")
        release(spark, path)
        path = new_path
        if labels.where("component <> old").isEmpty():
            release(spark, edges_path)
            return labels.select("id", "component")
