"""How few headings cover how many questions."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headingflow.operators.labels import value_counts
from headingflow.operators.numbering import number_rows

COVERAGE_PERCENTS = (50, 80, 90, 95)


def _ranked(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    counts = value_counts(df, column)
    ranked = number_rows(counts, [F.desc("n"), F.asc(column)], "rank", running={"cum": "n"})
    # ``cum`` of the last heading is the number of rows: no second scan for it.
    return ranked, ranked.agg(F.max("cum").alias("total"), F.max("rank").alias("headings"))


def heading_distribution(df: DataFrame, column: str = "heading") -> DataFrame:
    """Count, share, cumulative share and rank per heading, ties by heading; NULL is left out."""
    ranked, totals = _ranked(df, column)
    total = totals.select("total").scalar()
    return ranked.select(
        column,
        F.col("n").alias("count"),
        (F.col("n") / total).alias("share"),
        (F.col("cum") / total).alias("cum_share"),
        "rank",
    )


def coverage_thresholds(
    df: DataFrame, column: str = "heading", percents: Sequence[int] = COVERAGE_PERCENTS
) -> DataFrame:
    """Least number of top headings that cover each percentage of rows.

    The test runs on whole numbers, so no rounding can move a rank.
    """
    ranked, totals = _ranked(df, column)
    total = totals.select("total").scalar()
    reached = ranked.agg(
        F.array(
            *[
                F.struct(
                    F.lit(float(p) / 100).alias("threshold"),
                    F.min(F.when(F.col("cum") * 100 >= total * p, F.col("rank"))).alias("top_headings"),
                )
                for p in percents
            ]
        ).alias("reached"),
        F.max("rank").alias("headings"),
        F.max("cum").alias("questions"),
    )
    return reached.select(F.explode("reached").alias("r"), "headings", "questions").select(
        "r.threshold", "r.top_headings", "headings", "questions"
    )
