"""Connected components by spreading the smallest label, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airmill.session import discard, stored


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """``node`` and ``label`` (smallest node reachable) for every node of ``edges``; other nodes are their own label.

    Each round is two written tables, so a lost executor costs one round; a hub's messages are combined before the shuffle
    and its joins have an exchange on both sides, which adaptive execution can split. Labels only fall, so an unchanged sum
    means that none changed.
    """
    pairs = edges.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v"))
    pairs = stored(pairs.union(pairs.select("v", "u")).distinct())
    labels = stored(pairs.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("label")))
    before = None
    while True:
        sent = pairs.join(labels, F.col("u") == F.col("node")).select(F.col("v").alias("node"), "label")
        spread = stored(labels.union(sent).groupBy("node").agg(F.min("label").alias("label")))
        roots = spread.toDF("root", "root_label")
        jumped = stored(spread.join(roots, F.col("label") == F.col("root")).select("node", F.col("root_label").alias("label")))
        discard(labels, spread)
        labels = jumped
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total == before or total is None:
            discard(pairs)
            return labels
        before = total
