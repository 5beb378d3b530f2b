"""Connected components of a table of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenspan.llm._common import discard, written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); a component's label is its least node.

    Each round takes the least label among a node and its neighbours and then the label of that label, so that labels cross
    a chain in a logarithm of its length. Rounds are written tables: plans stay short, and lost executors cost one round.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("new"))
        ahead = labels.select(F.col("node").alias("at"), F.col("label").alias("jump"))
        jumped = step.join(ahead, step["new"] == ahead["at"]).select("node", F.least("new", "jump").alias("label"), (F.least("new", "jump") != F.col("label")).alias("moved"))
        after = written(jumped, "labels")
        discard(labels)
        labels = after
        if after.filter("moved").isEmpty():
            discard(both)
            labels = after.select("node", "label")
            labels.written_to = after.written_to
            return labels
