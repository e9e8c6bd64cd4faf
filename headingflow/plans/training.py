"""From a corpus to a fitted model, its scores and its report."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headingflow.functions.candidates import OTHER
from headingflow.functions.text import DEPARTMENT_INPUT, clean_question
from headingflow.operators.guards import require_columns
from headingflow.operators.labels import (
    MIN_HEADING_COUNT,
    collapse_rare,
    dictionary,
    encode,
    heading_counts,
)
from headingflow.operators.metrics import validation_metrics
from headingflow.operators.model import HeadingModel, logistic, naive_bayes, sweep
from headingflow.operators.split import SEED, VALIDATION_SHARE, split_rows
from headingflow.operators.vocabulary import MAX_LENGTH, NUM_WORDS
from headingflow.sources.files import append_run
from headingflow.sources.shared import materialise


def prepare_training(
    corpus: DataFrame,
    id_column: str,
    min_count: int = MIN_HEADING_COUNT,
    share: float = VALIDATION_SHARE,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The training table and its label map.

    Adds ``question_clean``, ``heading_collapsed``, ``label_id`` and ``split``.
    Counts, labels and the cuts of the split read the narrow columns only; the
    texts are read, cleaned and written once, in the last step.
    """
    text = "question_clean" if "question_clean" in corpus.columns else "question"
    require_columns(corpus, (id_column, text, "department", "heading"))
    counts = heading_counts(corpus)
    labels = dictionary(
        collapse_rare(counts, min_count=min_count, counts=counts), "heading_collapsed", "label_id"
    )
    texts = corpus
    if text == "question":
        texts = corpus.withColumn("question_clean", clean_question(text))
    whole = texts.select(
        id_column, "question_clean", F.coalesce("department", F.lit("")).alias("department"), "heading"
    )
    collapsed = collapse_rare(whole, min_count=min_count, counts=counts)
    coded = encode(collapsed, labels, "heading_collapsed", "label_id")
    split = split_rows(coded, id_column, "heading_collapsed", share, seed)
    return materialise(split, "training"), labels.withColumnRenamed("heading_collapsed", "heading")


def run_metadata(training: DataFrame, **settings) -> DataFrame:
    """One row that records a run: class counts, part sizes and the settings."""
    shown = {
        "num_words": NUM_WORDS,
        "maxlen": MAX_LENGTH,
        "val_split": VALIDATION_SHARE,
        "seed": SEED,
        "min_heading_count": MIN_HEADING_COUNT,
        "other_label": OTHER,
        "text_format": DEPARTMENT_INPUT,
        **settings,
    }
    # Two small groupings instead of distinct aggregates over every row.
    cells = training.groupBy("department", "heading_collapsed").agg(
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "val").alias("val"),
    )
    return cells.agg(
        F.count_distinct("department").alias("n_departments"),
        F.count_distinct("heading_collapsed").alias("n_headings"),
        F.sum("train").alias("train_rows"),
        F.sum("val").alias("val_rows"),
    ).select("*", *[F.lit(value).alias(name) for name, value in shown.items()])


def run_training(
    corpus: DataFrame,
    id_column: str,
    out: str,
    classifiers: dict | None = None,
    num_words: int = NUM_WORDS,
    **settings,
) -> tuple[HeadingModel, DataFrame]:
    """From a corpus to a saved model, its record and its validation metrics.

    Fits each classifier, keeps the best by validation top-1, saves it under
    ``<out>/model`` and appends the record of the run, with the objective of
    every iteration where the classifier keeps one, to ``<out>/runs``. Returns
    the model and the metrics of the validation rows.
    """
    training, labels = prepare_training(corpus, id_column, **settings)
    choices = classifiers or {"naive_bayes": naive_bayes(), "logistic": logistic()}
    model, results = sweep(training, labels, choices, num_words)
    model.save(f"{out}/model")
    best = max(results, key=lambda r: r.top1_accuracy or 0.0)
    last = model.pipeline.stages[-1]
    history = list(getattr(last, "objective_history", []))
    record = run_metadata(
        training,
        num_words=num_words,
        classifier=best.name,
        val_top1=best.top1_accuracy,
        val_top3=best.top3_accuracy,
        objective_history=history,
    )
    append_run(record.withColumn("objective_history", F.col("objective_history").cast("array<double>")), f"{out}/runs")
    val = model.predict(training.filter(F.col("split") == "val"), k=3)
    return model, validation_metrics(val, "heading_collapsed")
