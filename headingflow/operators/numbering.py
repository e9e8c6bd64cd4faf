"""Global row numbers and running sums without a global window."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headingflow.sources.shared import materialise


def number_rows(
    df: DataFrame, order: Sequence[Column], out: str, start: int = 1, running: dict[str, str] | None = None
) -> DataFrame:
    """Number all rows by ``order``, which must be unique per row.

    ``running`` maps new columns to the integer columns they sum up to the row.

    An unpartitioned window would sort the whole table in one task. Here a range
    partitioning makes ordered slices, each slice is numbered by itself, and the
    totals of the slices before it are added. The slices are written first, so
    that the slice of a row cannot change when a lost task runs again.
    """
    running = running or {}
    slices = materialise(
        df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    # One row per slice, thus at most as many as shuffle partitions.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = slices.groupBy("_slice").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{n}") for n, c in running.items()]
    )
    offsets = totals.select(
        "_slice",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_sum_{n}") for n in running],
    )
    inside = Window.partitionBy("_slice").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return slices.join(F.broadcast(offsets), "_slice").select(
        *df.columns,
        (F.col("_rows") + F.row_number().over(inside) - 1 + start).alias(out),
        *[(F.col(f"_sum_{n}") + F.sum(c).over(upto)).alias(n) for n, c in running.items()],
    )
