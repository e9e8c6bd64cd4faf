"""The daily job: documents to predictions to metrics, upserted per day."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headingflow.functions.text import clean_question
from headingflow.operators.canon import extract_questions
from headingflow.operators.guards import report_ks, require_rows
from headingflow.operators.metrics import REPORT_KS, daily_metrics
from headingflow.operators.upsert import upsert_table
from headingflow.sources.large_json import read_questions
from headingflow.sources.shared import materialise

Scorer = Callable[[DataFrame], DataFrame]


def score_with_models(asked: DataFrame, models: dict[str, Scorer]) -> DataFrame:
    """Predictions of every model over the same questions, told apart by ``model``."""
    parts = [score(asked).withColumn("model", F.lit(name)) for name, score in models.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def run_daily(
    documents: DataFrame,
    models: dict[str, Scorer],
    metrics_path: str,
    predictions_path: str | None = None,
    ks: Sequence[int] = REPORT_KS,
    max_k: int = 10,
    parts: int | None = None,
) -> DataFrame:
    """Extract, score, measure and upsert by model and day; returns the metrics of this run.

    The questions are extracted and cleaned once for all models, and scoring runs
    once per model: its output is written before the metrics read it. ``parts``
    deals the questions out anew, for documents in files that cannot be split.
    """
    asked = extract_questions(documents)
    if parts:
        asked = asked.repartition(parts)
    return measure_questions(asked, models, metrics_path, predictions_path, ks, max_k)


def run_daily_files(
    spark: SparkSession,
    path: str,
    models: dict[str, Scorer],
    metrics_path: str,
    rejects_path: str,
    predictions_path: str | None = None,
    ks: Sequence[int] = REPORT_KS,
    max_k: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """``run_daily`` over documents of any size, each a file: the metrics, and what could not be read.

    Documents and items with faults are put into the table at ``rejects_path``
    with their reasons, in place of those of the run before, and cost no other.
    """
    asked, rejects = read_questions(spark, path)
    rejects.write.mode("overwrite").parquet(rejects_path)
    metrics = measure_questions(asked, models, metrics_path, predictions_path, ks, max_k)
    return metrics, spark.read.schema(rejects.schema).parquet(rejects_path)


def measure_questions(
    asked: DataFrame,
    models: dict[str, Scorer],
    metrics_path: str,
    predictions_path: str | None = None,
    ks: Sequence[int] = REPORT_KS,
    max_k: int = 10,
) -> DataFrame:
    """Score, measure and upsert extracted questions by model and day."""
    ks = report_ks(ks, max_k)
    asked = materialise(asked.withColumn("question_clean", clean_question("question")), "questions")
    require_rows(asked)
    scored = score_with_models(asked, models)
    if predictions_path is None:
        predictions = materialise(scored, "predictions")
    else:
        scored.write.mode("overwrite").parquet(predictions_path)
        predictions = asked.sparkSession.read.schema(scored.schema).parquet(predictions_path)
    metrics = materialise(daily_metrics(predictions, ks=ks, keys=("model", "date")), "metrics")
    upsert_table(metrics, metrics_path, keys=("model", "date"))
    return metrics

