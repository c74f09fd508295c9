"""Connected components of an edge table, by joins and group-bys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: each node of ``edges`` with the smallest node it reaches.

    Each round gives a node the least label among its own and its neighbours', then follows
    the label's own label once, so long chains halve. Group-bys pre-aggregate map-side, so a
    node with very many edges costs one row per task. Rounds are written to the shared folder
    and stop when no label changes. Nulls and loops are ignored; no edges give no nodes.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v")
    both = materialize(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = materialize(both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("label"))
                         .withColumnRenamed("u", "node"), "labels")
    while True:
        near = (both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("label").alias("near")))
        least = labels.join(near, labels["node"] == near["u"]).select(
            "node", "label", F.least("label", "near").alias("step"))
        jump = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        moved = materialize(
            least.join(jump, least["step"] == jump["_n"], "left")
            .select("node", F.least("step", F.coalesce("_l", "step")).alias("label"),
                    (F.least("step", F.coalesce("_l", "step")) != F.col("label")).alias("changed")), "labels")
        labels = moved.select("node", "label")
        if moved.filter("changed").isEmpty():
            return labels.withColumnRenamed("label", "component")
