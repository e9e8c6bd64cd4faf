"""Bounded samples of labelled documents."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each label that a model is fitted on, at most.
LABELLED_ROWS = 20_000


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str,
    id_column: str = "doc_id",
    most: int = LABELLED_ROWS,
) -> DataFrame:
    """The rows of ``docs`` with ``_label`` 0 or 1, ``most`` of each at most: those with the smallest hash of the id.

    ``_weight`` is how many labelled ids each row stands for: those of its label
    over those sampled. Weighted rows have the shares of the whole, so what is
    fitted on them does not depend on whether ``most`` was reached.

    Only the sampled ids are broadcast, and their number is bounded by ``most``,
    so the documents are not shuffled. NULL ids and other labels are left out;
    an id labelled twice keeps its larger label.
    """
    known = (
        labels.select(F.col(id_column).alias("_key"), F.col(label_column).cast("int").alias("_label"))
        .filter("_key is not null and _label in (0, 1)")
        .groupBy("_key")
        .agg(F.max("_label").alias("_label"))
    )
    totals = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    parts = [known.filter(F.col("_label") == v).orderBy(F.xxhash64("_key"), "_key").limit(most) for v in (0, 1)]
    chosen = F.broadcast(reduce(DataFrame.unionByName, parts))
    one, zero = (F.lit(max(1.0, totals.get(v, 0) / most)) for v in (1, 0))
    sampled = docs.join(chosen, F.col(id_column) == F.col("_key")).drop("_key")
    return sampled.withColumn("_weight", F.when(F.col("_label") == 1, one).otherwise(zero))
