"""Connected components of a graph of links."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwave.llm.tables import written


def connected(links: DataFrame) -> DataFrame:
    """id, root of every end of ``links`` (a, b); the root is the smallest id
    of the component.

    Each turn every node takes the smallest label among itself and its
    neighbours, then the label of that label, so that long chains shrink by
    powers. It ends when a turn changes nothing. Every turn is written to the
    shared folder. A node with very many links only gathers a minimum, which
    combines before the shuffle.
    """
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("id"), F.col("a").alias("other")))
    both = written(both.where("id != other").distinct(), "links")
    labels = written(both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("root")), "labels")
    while True:
        seen = (both.join(labels.withColumnRenamed("id", "other"), "other")
                .groupBy("id").agg(F.min("root").alias("near")))
        step = labels.join(seen, "id").select("id", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("id").alias("root"), F.col("root").alias("over"))
        step = written(step.join(jump, "root", "left").select(
            "id", "old", F.least("root", F.coalesce("over", "root")).alias("root")), "labels")
        labels = step.select("id", "root")
        if step.where("old != root").isEmpty():
            return labels
