"""Replace rows by key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headingflow.sources.shared import materialise


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("date",)) -> DataFrame:
    """Old rows whose key is not in ``new``, then the new rows, sorted by key.

    The columns are the union of both, the old ones first; a missing one is NULL.
    The new rows are written first, as they are read twice.
    """
    keys = list(keys)
    new = materialise(new, "upsert")
    kept = old.join(new.select(*keys).distinct(), keys, "left_anti").select(*old.columns)
    return kept.unionByName(new, allowMissingColumns=True).orderBy(*keys)


def upsert_table(new: DataFrame, path: str, keys: Sequence[str] = ("date",)) -> None:
    """Upsert into a Parquet table partitioned by the keys.

    Only the partitions present in ``new`` are replaced, when the job commits;
    the table is never read, so a second run gives the same table. Partition
    values are read back as text.
    """
    keys = list(keys)
    written = new.select(*[c for c in new.columns if c not in keys], *[F.col(k).cast("string") for k in keys])
    (
        written.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str, keys: Sequence[str] = ("date",)) -> DataFrame:
    """The upserted table: the keys first, then the union of all columns ever written."""
    keys = list(keys)
    table = spark.read.option("mergeSchema", True).parquet(path)
    others = [c for c in table.columns if c not in keys]
    return table.select(*[F.col(k).cast("string").alias(k) for k in keys], *others).orderBy(*keys)
