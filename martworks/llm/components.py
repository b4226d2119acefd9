"""Connected components of links between integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.scratch import Scratch


def components(scratch: Scratch, links: DataFrame, name: str) -> DataFrame:
    """``node, label`` for every id in ``links`` (``a, b``): the smallest id that it is connected with.

    Each round takes the smallest label among the neighbours and then the label of that label, so the rounds grow with
    the logarithm of the longest chain. A round is one written table. Hot nodes are pre-aggregated before the shuffle
    by the grouping, and split by adaptive execution in the joins.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    steps = scratch.within(f"{name}-steps")
    edges = steps.keep("edges", both.where("a <> b").distinct())
    labels = steps.keep("0", edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.min("a")).alias("label")))
    total, turn = _total(labels), 0
    while total is not None:
        turn += 1
        near = (edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("least")))
        step = labels.join(near, "node").select("node", F.least("label", "least").alias("label"))
        target = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = steps.keep(f"{turn}", step.join(target, "label").select("node", F.col("next").alias("label")))
        before, total = total, _total(labels)
        if total == before:
            break
    labels = scratch.keep(name, labels)
    steps.clear()
    return labels


def _total(labels: DataFrame):
    """Labels only ever sink, so their sum tells whether any changed."""
    return labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
