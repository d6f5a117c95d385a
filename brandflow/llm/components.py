"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): label is the smallest node of its component.

    Each round, every node takes the smallest label among its own, its
    neighbours' and its label's label. The last one halves the depth of chains,
    so a component of n nodes takes about log n rounds. Each round's labels are
    written, which bounds what is replayed when an executor is lost.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    edges = written(both, "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = (
            labels.join(near, "node")
            .join(far, "label")
            .select("node", F.least("label", "near", "far").alias("label"), (F.least("near", "far") < F.col("label")).alias("moved"))
        )
        new = written(new, "labels")
        moved = new.where("moved").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels
