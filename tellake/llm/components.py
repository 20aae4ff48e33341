"""Connected components of a link table: minimum labels, hooked at roots, with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node of the links; root is the smallest node it reaches.

    In each step a node takes the smallest label among its neighbours and hands it to its
    own former label too, so that whole groups join where they touch; then each label is
    replaced by that label's label.  Every step is written to the shared folder: lineage
    stays short and a lost executor costs one step.  Null ends are ignored; no links: no rows.
    """
    slim = links.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna().filter("a <> b")
    edges = materialize(slim.union(slim.select("b", "a")).distinct(), "edges")
    labels = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")), "labels")
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("root").alias("low"))
        told = labels.join(near, labels.node == near.a).select(F.explode(F.array(F.struct("node", "root"), F.struct(F.col("root").alias("node"), F.lit(None).cast(labels.schema["root"].dataType).alias("root")))).alias("e"), F.least("root", "low").alias("next"))
        nearer = told.groupBy("e.node").agg(F.min("next").alias("next"), F.max("e.root").alias("was"))
        up = labels.select(F.col("node").alias("next"), F.col("root").alias("over"))
        step = materialize(nearer.join(up, "next").select("node", F.least("next", "over").alias("root"), "was"), "labels")
        labels = step.select("node", "root")
        if step.filter("root <> was").isEmpty():
            return labels


def join_components(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, root) that links (a, b) make of the components given; only links between groups are followed."""
    of_a, of_b = (roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab")
    between = links.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    over = connected_components(between).select(F.col("node").alias("root"), F.col("root").alias("top"))
    fresh = over.join(roots.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("top").alias("root"))
    return materialize(roots.join(over, "root", "left").select("node", F.coalesce("top", "root").alias("root")).unionByName(fresh), "labels")
