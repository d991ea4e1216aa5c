"""Connected components over an edge table, by joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm.common import Scratch


def components(edges: DataFrame, a: str = "a", b: str = "b", scratch: Scratch | None = None, name: str = "labels") -> DataFrame:
    """(node, label): label is the smallest node that the node reaches over `edges`. With a `scratch`, the result is its table `name`.

    A round gives each node the smallest label among itself and its neighbours: stars are done after two. From the third round on
    labels are also followed one step (pointer jumping), so that chains take about the logarithm of their length. Minima are aggregated map-side, so
    a hub costs one row a task, and its edges meet its label in a plain equi-join. Labels only fall, so equal sums mean that nothing changed. Null
    ends are ignored; no edges give no rows.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    loops = pairs.select("u", F.col("u").alias("v")).union(pairs.select("v", F.col("v").alias("v2")))
    scratch = scratch or Scratch(edges.sparkSession, "components")
    both = scratch.put(f"{name}-edges", pairs.union(pairs.select("v", "u")).union(loops).distinct())
    labels = scratch.put(name, both.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node"))
    last, rounds = None, 0
    while True:
        rounds += 1
        new = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("label").alias("label")).withColumnRenamed("u", "node")
        if rounds > 1:
            jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
            new = new.join(jump, "label", "left").select("node", F.least("label", "further").alias("label"))
        labels = scratch.put(name, new)
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total == last:
            scratch.drop(f"{name}-edges")
            return labels
        last = total
