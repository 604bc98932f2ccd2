"""Connected components of a link table, by minimum labels and pointer jumping on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.scratch import drop, stage


def components(links: DataFrame) -> DataFrame:
    """Label every node of ``links`` (a long, b long) with the smallest node reachable: (node, label).

    Each round takes the smallest label among a node's neighbours (a partial aggregate, so a hub
    is combined before the shuffle) and then the label of that label; it ends when nothing
    changes.  Nodes without a link are not listed.  Null ends are ignored; repeated links and
    self links change nothing; no links give no rows.
    """
    links = links.filter("a is not null and b is not null")
    both = stage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("low")), "b").groupBy(F.col("a").alias("node")).agg(F.min("low").alias("low"))
        lowered = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "low").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("low"))
        fresh = stage(lowered.join(jump, "mid").select("node", "was", F.least("mid", "low").alias("label")), "labels")
        changed = fresh.filter("label < was").limit(1).count()
        drop(labels)
        labels = fresh
        if not changed:
            drop(both)
            return labels.select("node", "label")
