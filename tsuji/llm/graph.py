"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b`` longs): root is the smallest node it can
    reach. Every round takes the smallest label among the neighbours, then follows labels once
    (halving paths); each round is a written table, so no round repeats an earlier one."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.where("a <> b").distinct(), f"{name}-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("root")), f"{name}-0")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m")))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        # the root's own new label
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("up"))
        new = written(step.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("up", "root")).alias("root")),
                      f"{name}-round")
        changed = new.where("root <> old").limit(1).count()
        labels = new.select("node", "root")
        if not changed:
            return labels
