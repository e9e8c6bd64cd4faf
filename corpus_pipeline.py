"""A training corpus from raw documents: classified, deduplicated, decontaminated, mixed, written as token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All stages but
the last return the columns of the documents they were given.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headingflow.llm.co_training import THRESHOLD, fit_quality, score_quality
from headingflow.llm.decontamination import find_passages
from headingflow.llm.near_duplicates import near_duplicates
from headingflow.llm.queries import mixed, table, token_digests
from headingflow.llm.storage import drop, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Words that a worker remembers while it encodes: few, as it still holds memory of the stages before.
KNOWN_WORDS = 60_000


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model, out="_quality")
    return scored.filter(F.col("_quality.probability") >= THRESHOLD).select(*docs.columns)


def _without(docs: DataFrame, rejected: DataFrame, name: str) -> DataFrame:
    """The documents whose id is not among the rejected; rows with a NULL id stay.

    The ids are written first, so Spark knows their size: it broadcasts few, and
    shuffles many.
    """
    ids, _ = written(rejected.select(F.col("doc_id").alias("_gone")).distinct(), name)
    return docs.join(ids, F.col("doc_id") == F.col("_gone"), "left_anti")


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return _without(docs, near_duplicates(docs).filter("not kept"), "duplicates")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return _without(docs, find_passages(docs, table(spark, sf_dir, "benchmark")), "leaks")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as its source's epochs take it."""
    chosen = mixed(docs, "_copies").filter("_copies > 0")
    # A copy is a row of its own.
    repeated = chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return repeated.select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Files of token ids, and what they hold for each document."""
    return token_digests(docs, known=KNOWN_WORDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_deduplication", near_deduplication),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: Models, tokenizers and alignments are not SQL; the tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if last:
            drop(spark, last)
        last = path
    return docs
