"""Connected components of links by iterated joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headingflow.llm.storage import drop, written


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """``node, label`` of every node of the links ``a, b``: the smallest node it reaches. And its path.

    Each round takes the smallest label among the neighbours and then the label
    of that label, so paths shorten by half. Every round is written, which cuts
    the lineage; links and labels never leave the executors.
    """
    spark = links.sparkSession
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges, edges_path = written(both, "edges")
    start = edges.groupBy("a").agg(F.min("b").alias("b"))
    labels, path = written(start.select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels.node == near.a).select("node", F.least("label", "near").alias("lower"), "label")
        of = labels.select(F.col("node").alias("_of"), F.col("label").alias("_next"))
        made = lower.join(of, F.col("lower") == F.col("_of")).select(
            "node", F.least("lower", "_next").alias("label"), F.col("label").alias("_old")
        )
        rows, new_path = written(made, "labels")
        done = rows.filter(F.col("label") != F.col("_old")).isEmpty()
        drop(spark, path)
        labels, path = rows.drop("_old"), new_path
        if done:
            drop(spark, edges_path)
            return labels, path
