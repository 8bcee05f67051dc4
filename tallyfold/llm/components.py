"""Connected components of a link table by repeated minimum labels, cut at each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.session import stage


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected to, for nodes with a link.

    Each round hooks every label onto the smallest label beside it, then follows labels
    twice, so long chains shrink fast; rounds end when no link joins two labels. Each round's
    tables are written to the shared folder. Nulls take no part.
    """
    edges = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b").distinct()
    edges = stage(edges, "links")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node"))
    labels = stage(nodes.distinct().withColumn("label", F.col("node")), "labels")
    live = edges
    while not live.isEmpty():
        both = live.select("a", "b").union(live.select(F.col("b"), F.col("a"))).toDF("label", "beside")
        hook = both.groupBy("label").agg(F.min("beside").alias("to")).where("to < label")
        hook = stage(hook, "hooks")
        far = hook
        for _ in range(2):
            nxt = hook.select(F.col("label").alias("to"), F.col("to").alias("further"))
            far = far.join(nxt, "to", "left").select("label", F.coalesce("further", "to").alias("to"))
        far = stage(far, "hooks")
        labels = labels.join(far, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        labels = stage(labels, "labels")
        for end in ("a", "b"):
            moved = far.select(F.col("label").alias(end), "to")
            live = live.join(moved, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        live = stage(live.where("a <> b").distinct(), "links")
    return labels
