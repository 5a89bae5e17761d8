"""Connected components of a link table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links` (a, b); the component is its smallest node.

    Each round gives a node the smallest label among its neighbours, then the label of its label. A round is two joins and
    one folded aggregate over the links, whatever the size of a group, and is written, so that a lost executor costs a
    read. The rounds grow with the logarithm of the longest path.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    both = written(both.toDF("node", "other"), "links")
    labels = written(both.groupBy("node").agg(F.min("other").alias("_m")).select(
        "node", F.least("node", "_m").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(
            F.min("component").alias("_m"))
        low = labels.join(near, "node").select("node", "component", F.least("component", "_m").alias("_low"))
        jump = labels.select(F.col("node").alias("_low"), F.col("component").alias("_next"))
        new = written(low.join(jump, "_low").select("node", "component", F.least("_low", "_next").alias("_new")), "labels")
        labels = new.select("node", F.col("_new").alias("component"))
        if not new.filter("_new <> component").limit(1).count():
            return labels
