"""Between the candidate array and the wide columns of the files."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def widen_candidates(
    df: DataFrame,
    k: int,
    column: str = "candidates",
    skip_first: bool = False,
    shown: int | None = None,
) -> DataFrame:
    """Add ``alt_heading_j`` and ``alt_conf_j`` for j = 1..k and drop the array.

    Alternate 1 is the prediction itself; with ``skip_first`` it is the second
    best and there are k - 1. ``shown`` limits the pairs below k.
    """
    first = 1 if skip_first else 0
    pairs = min(k - first, k if shown is None else shown)
    wide = []
    for j in range(1, pairs + 1):
        candidate = F.get(column, F.lit(j - 1 + first))
        wide.append(candidate["heading"].alias(f"alt_heading_{j}"))
        wide.append(candidate["conf"].alias(f"alt_conf_{j}"))
    return df.select(*[c for c in df.columns if c != column], *wide)


def gather_candidates(df: DataFrame, k: int, out: str = "candidates") -> DataFrame:
    """The array again from those of the wide columns that are present."""
    present = [j for j in range(1, k + 1) if f"alt_heading_{j}" in df.columns]
    entries = [
        F.struct(
            F.lit(place).alias("rank"),
            F.col(f"alt_heading_{j}").cast("string").alias("heading"),
            (
                F.col(f"alt_conf_{j}").try_cast("double")
                if f"alt_conf_{j}" in df.columns
                else F.lit(None).cast("double")
            ).alias("conf"),
        )
        for place, j in enumerate(present, start=1)
    ]
    empty = F.array().cast("array<struct<rank:int,heading:string,conf:double>>")
    return df.withColumn(out, F.array(*entries) if entries else empty)


def alternate_columns(k: int) -> Sequence[str]:
    return [name for j in range(1, k + 1) for name in (f"alt_heading_{j}", f"alt_conf_{j}")]


def top_k_rows(
    df: DataFrame, id_column: str, class_column: str, score_column: str, k: int, out: str = "rank"
) -> DataFrame:
    """Top k per id of a table that already has one row per id and class, ties by class."""
    order = Window.partitionBy(id_column).orderBy(F.desc(score_column), F.asc(class_column))
    return df.withColumn(out, F.row_number().over(order)).filter(F.col(out) <= k)
