"""Connected components over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftforge.llm.common import release, stage


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, comp): the smallest node that each node of ``edges`` (a, b) is
    linked with, directly or not; ``labels`` is an earlier result to go on from.

    Each round every node takes the least component among its neighbours', and
    the component's own component (pointer jump), so paths halve. Rounds end
    when none changes. Nothing is collected; neighbours are combined before the
    shuffle, so a node with very many links is no hot spot there."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if labels is not None:
        both = both.union(labels.filter("node != comp").select(F.col("node").alias("a"), F.col("comp").alias("b")))
        both = both.union(labels.filter("node != comp").select(F.col("comp").alias("a"), F.col("node").alias("b")))
    both = stage(both, "links", compact=True)
    now = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp"))
                .select("node", F.least("node", "comp").alias("comp")), "labels", compact=True)
    while True:
        heard = (both.join(now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                 .agg(F.min("comp").alias("heard")))
        step = now.join(heard, "node").select("node", F.col("comp").alias("old"),
                                              F.least("comp", "heard").alias("comp"))
        up = now.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = stage(step.join(up, "comp", "left").select(
            "node", "old", F.least("comp", F.coalesce("up", "comp")).alias("comp")), "labels", compact=True)
        changed = new.filter("comp != old").limit(1).count()
        release(now)
        now = new.select("node", "comp")
        now._staged_at = new._staged_at
        if not changed:
            release(both)
            return now
