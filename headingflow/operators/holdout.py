"""Hold-out report: scalars, review rates, departments and an error sample.

The confidence stays NULL where it is missing: such a row is never under
review and is left out of means.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headingflow.functions.candidates import reported_hit
from headingflow.functions.values import number, text_or_empty
from headingflow.sources.shared import discard, materialise

REVIEW_THRESHOLDS = (0.20, 0.25, 0.30, 0.35, 0.40)


def _correct(truth: str):
    return text_or_empty(F.col("pred_heading")) == text_or_empty(F.col(truth))


def holdout_report(predictions: DataFrame, truth: str = "heading") -> DataFrame:
    """One row: rows, top-1 rate, any-alternate hit rate, share predicted as other."""
    predicted = text_or_empty(F.col("pred_heading"))
    flags = predictions.select(
        _correct(truth).alias("top1"),
        reported_hit(F.col(truth), predicted, F.col("candidates")).alias("topk"),
        (F.lower(predicted) == "other").alias("other"),
    )
    return flags.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("top1").cast("int")).alias("top1"),
        F.avg(F.col("topk").cast("int")).alias("topk"),
        F.avg(F.col("other").cast("int")).alias("other_rate"),
    )


def review_sweep(predictions: DataFrame, thresholds: Sequence[float] = REVIEW_THRESHOLDS) -> DataFrame:
    """Share and number of rows under review at each threshold, from one aggregation."""
    conf = number(F.col("pred_confidence"))
    totals = predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.array(
            *[
                F.struct(F.lit(float(t)).alias("threshold"), F.count_if(conf < float(t)).alias("items"))
                for t in thresholds
            ]
        ).alias("sweep"),
    )
    return totals.select("n", F.explode("sweep").alias("s")).select(
        "s.threshold", F.try_divide("s.items", "n").alias("review_rate"), "s.items"
    )


def department_summary(predictions: DataFrame, truth: str = "heading", top: int = 20) -> DataFrame:
    """Rows, top-1 rate and mean confidence of the largest departments, NULL being one of them."""
    return (
        predictions.select(
            "department", _correct(truth).cast("int").alias("hit"), number(F.col("pred_confidence")).alias("conf")
        )
        .groupBy("department")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("hit").alias("top1"), F.avg("conf").alias("avg_conf"))
        .orderBy(F.desc("n"), F.asc_nulls_first("department"))
        .limit(top)
    )


def error_sample(
    predictions: DataFrame, id_column: str, keep: Sequence[str], truth: str = "heading", size: int = 50
) -> DataFrame:
    """The most and the least confident wrong rows, each once; a missing confidence counts as -1.

    Of ``keep`` only the present columns are shown. Both halves are top-n over
    ids and confidences alone, which keep ``size`` rows per task; the chosen ids
    then fetch their rows, so texts are read once.
    """
    wrong = predictions.filter(~_correct(truth)).withColumn(
        "pred_confidence", number(F.col("pred_confidence"), default=-1.0)
    )
    shown = [c for c in keep if c in wrong.columns]
    rows = wrong.select(id_column, *[c for c in shown if c != id_column])
    narrow = materialise(wrong.select(F.col(id_column).alias("_id"), F.col("pred_confidence").alias("_conf")), "wrong")
    sure = narrow.orderBy(F.desc("_conf"), F.asc("_id")).limit(size)
    unsure = narrow.orderBy(F.asc("_conf"), F.asc("_id")).limit(size)
    # At most twice ``size`` ids.
    chosen = materialise(sure.unionByName(unsure).select("_id").distinct(), "error-ids")
    discard(narrow)
    return rows.join(chosen, F.col(id_column) == F.col("_id"), "left_semi").distinct()
