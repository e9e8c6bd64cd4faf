"""Keep the daily metrics up to date from a folder of landed documents."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headingflow.operators.canon import extract_questions
from headingflow.operators.metrics import REPORT_KS, daily_metrics
from headingflow.operators.upsert import upsert_table
from headingflow.plans.daily import Scorer, score_with_models
from headingflow.sources.shared import discard, materialise

STORED = ("model", "heading", "pred_heading", "pred_confidence", "candidates", "date", "batch")


def refresh_metrics(
    spark: SparkSession,
    landing: str,
    models: dict[str, Scorer],
    predictions_path: str,
    metrics_path: str,
    checkpoint: str,
    ks: Sequence[int] = REPORT_KS,
) -> StreamingQuery:
    """Process the files that have landed since the last run, then stop.

    A file holds one document per line, and each question lands once. Every
    batch writes its predictions under its own number and then measures the days
    it touched over all batches, so a day may arrive in any number of files. A
    batch that runs again after a failure replaces what it wrote before.
    """

    def refresh(batch: DataFrame, number: int) -> None:
        asked = materialise(extract_questions(batch), "questions")
        if asked.isEmpty():
            return
        scored = score_with_models(asked, models).withColumn("batch", F.lit(number))
        # One file per day and batch, a few for a day with most of the rows.
        clustered = scored.select(*STORED).repartition("date", F.pmod(F.xxhash64("heading"), F.lit(4)))
        upsert_table(clustered, predictions_path, keys=("date", "batch"))

        session = batch.sparkSession
        stored = session.read.schema(scored.select(*STORED).schema).parquet(predictions_path)
        # The touched days prune the partitions that are read.
        touched = stored.join(materialise(_days(asked), "days"), "date", "left_semi")
        metrics = daily_metrics(touched, ks=ks, keys=("model", "date"))
        upsert_table(materialise(metrics, "metrics"), metrics_path, keys=("model", "date"))
        discard(asked)

    return (
        spark.readStream.text(landing)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _days(asked: DataFrame) -> DataFrame:
    """The calendar days in the batch: at most one row per day of the calendar."""
    return asked.select("date").distinct()
