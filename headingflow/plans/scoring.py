"""Scoring of landed files, and the report on scored files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headingflow.functions.candidates import needs_review
from headingflow.operators import holdout
from headingflow.operators.canon import zip_arrays
from headingflow.operators.guards import clamp_topk, require_columns, require_known, require_rows
from headingflow.operators.labels import decode
from headingflow.operators.model import HeadingModel
from headingflow.operators.widen import alternate_columns, gather_candidates, widen_candidates
from headingflow.sources.files import read_upload, write_csv, write_dated

UPLOAD_MAX_K = 10
CSV_ALTERNATES = 3
REPORT_ALTERNATES = 5


def score_upload(
    spark: SparkSession, path: str, model: HeadingModel, out: str, k: int = 4, per_line: bool = False
) -> DataFrame:
    """Score an uploaded CSV or JSON and write the input with the prediction and k alternates as CSV."""
    k = clamp_topk(k, UPLOAD_MAX_K)
    uploaded = require_columns(read_upload(spark, path, per_line=per_line), ("question", "department"))
    scored = model.predict(uploaded, k).select(*uploaded.columns, "pred_heading", "pred_confidence", "candidates")
    wide = widen_candidates(scored, k)
    write_csv(wide, out)
    return wide


def score_questions(
    asked: DataFrame, model: HeadingModel, departments: DataFrame, k: int = 3
) -> DataFrame:
    """Operational scoring: known departments only, never the collecting heading, a review flag.

    ``departments`` lists the departments of the training in ``department``.
    """
    require_columns(asked, ("question", "department"))
    require_known(asked, departments, "department")
    k = clamp_topk(k)
    scored = model.predict(asked, k, never_other=True)
    flagged = scored.withColumn("needs_review", needs_review(F.col("pred_confidence")))
    return widen_candidates(flagged, k, shown=CSV_ALTERNATES)


def score_arrays(
    batches: DataFrame,
    departments_json: str,
    questions_json: str,
    id_column: str,
    departments: DataFrame,
    model: HeadingModel,
    out: str,
    run_date: str,
    fmt: str = "json",
) -> DataFrame:
    """Score parallel arrays of department codes and questions into the folder of the run date.

    ``departments`` maps ``department_id`` to ``department``.
    """
    rows = zip_arrays(batches, departments_json, questions_json, id_column)
    named = decode(
        rows, departments, "department_code", "department", "department", known_id="department_id"
    )
    scored = model.predict(named, k=1).select("question", F.col("pred_heading").alias("predicted_heading"))
    write_dated(scored, out, run_date, fmt)
    return scored


def evaluate_predictions(
    predictions: DataFrame, id_column: str, truth: str = "heading"
) -> dict[str, DataFrame]:
    """The whole hold-out report over wide or gathered predictions."""
    require_columns(predictions, ("question", "department", truth, "pred_heading", "pred_confidence"))
    require_rows(predictions)
    if "candidates" in predictions.columns:
        gathered, wide = predictions, widen_candidates(predictions, CSV_ALTERNATES)
    else:
        gathered, wide = gather_candidates(predictions, REPORT_ALTERNATES), predictions
    keep = ["question", "department", truth, "pred_heading", "pred_confidence"]
    return {
        "report": holdout.holdout_report(gathered, truth),
        "review": holdout.review_sweep(gathered),
        "departments": holdout.department_summary(gathered, truth),
        "errors": holdout.error_sample(wide, id_column, [*keep, *alternate_columns(CSV_ALTERNATES)], truth),
    }
