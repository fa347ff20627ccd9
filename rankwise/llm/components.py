"""Connected components of an edge table, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwise.functions.materialize import materialize


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) for every id on an edge (a, b).

    Every round each node takes the least label among its own and its
    neighbours', then the label of that label; a written table per round
    cuts the lineage, and one number (labels changed) reaches the driver.
    A node with very many edges is reduced map side (a minimum).
    """
    both = materialize(edges.select("a", "b").filter("a <> b")
                       .unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).filter("a <> b")).distinct(),
                       "component-edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                         .select(F.col("a").alias("id"), F.least("a", "m").alias("component")), "component-labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("near")), "b")
                .groupBy("a").agg(F.min("near").alias("near")))
        low = labels.join(near, labels["id"] == near["a"]).select("id", F.col("component").alias("was"),
                                                                  F.least("component", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("component").alias("further"))
        new = materialize(low.join(jump, "low").select("id", "was", F.least("low", "further").alias("component")),
                          "component-labels")
        labels = new.select("id", "component")
        if new.filter("was <> component").isEmpty():
            return labels
