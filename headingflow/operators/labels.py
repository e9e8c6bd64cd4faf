"""Headings as labels: counts, rare headings, dictionaries and lookups."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headingflow.functions.candidates import OTHER, decode_classes, unknown_heading
from headingflow.operators.numbering import number_rows
from headingflow.sources.shared import materialise

MIN_HEADING_COUNT = 8


def value_counts(df: DataFrame, column: str = "heading", out: str = "n") -> DataFrame:
    """Rows per value, NULL left out."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(out))


def heading_counts(df: DataFrame, column: str = "heading") -> DataFrame:
    """Rows per heading with NULL as ``""``, written once for the lookups that follow."""
    filled = df.select(F.coalesce(F.col(column), F.lit("")).alias(column))
    return materialise(filled.groupBy(column).agg(F.count(F.lit(1)).alias("n")), "heading-counts")


def collapse_rare(
    df: DataFrame,
    column: str = "heading",
    out: str = "heading_collapsed",
    min_count: int = MIN_HEADING_COUNT,
    other: str = OTHER,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Headings with fewer than ``min_count`` rows become ``other``; NULL counts as ``""``."""
    counts = heading_counts(df, column) if counts is None else counts
    rare = counts.filter(F.col("n") < min_count).select(
        F.col(column).alias("_key"), F.lit(True).alias("_rare")
    )
    filled = F.coalesce(F.col(column), F.lit(""))
    return (
        df.join(rare, filled == F.col("_key"), "left")
        .withColumn(out, F.when(F.col("_rare"), F.lit(other)).otherwise(filled))
        .drop("_key", "_rare")
    )


def collapse_summary(
    df: DataFrame,
    column: str = "heading",
    min_count: int = MIN_HEADING_COUNT,
    other: str = OTHER,
    counts: DataFrame | None = None,
) -> DataFrame:
    """One row: distinct headings before and after, rare ones, fall in number, rows in ``other``.

    Read from the counts alone. ``n_rare`` counts the rare headings; ``n_fewer``
    is before minus after, one less when ``other`` is new.
    """
    counts = heading_counts(df, column) if counts is None else counts
    rare = F.col("n") < min_count
    to_other = rare | (F.col(column) == other)
    return counts.agg(
        F.count(F.lit(1)).alias("n_before"),
        (F.count_if(~to_other) + F.when(F.count_if(to_other) > 0, 1).otherwise(0)).alias("n_after"),
        F.count_if(rare).alias("n_rare"),
        F.coalesce(F.sum(F.when(to_other, F.col("n"))), F.lit(0)).alias("rows_other"),
    ).select(
        "n_before", "n_after", "n_rare", (F.col("n_before") - F.col("n_after")).alias("n_fewer"), "rows_other"
    )


def dictionary(df: DataFrame, column: str, out: str) -> DataFrame:
    """Sorted distinct values numbered from 0, NULL as ``""``, written to the shared folder."""
    values = df.select(F.coalesce(F.col(column), F.lit("")).alias(column)).distinct()
    numbered = number_rows(values, [F.col(column)], out, start=0)
    return materialise(numbered.withColumn(out, F.col(out).cast("int")), "dictionary")


def encode(df: DataFrame, known: DataFrame, column: str, out: str) -> DataFrame:
    """Add the id of the value from a dictionary with columns ``column`` and ``out``."""
    lookup = known.select(F.col(column).alias("_key"), F.col(out))
    return df.join(lookup, F.coalesce(F.col(column), F.lit("")) == F.col("_key"), "left").drop("_key")


def decode(
    df: DataFrame, known: DataFrame, id_column: str, column: str, out: str, unknown: str = "{}",
    known_id: str | None = None,
) -> DataFrame:
    """Add the value of an id; an id outside the dictionary goes into the ``unknown`` template."""
    lookup = known.select(F.col(known_id or id_column).alias("_key"), F.col(column).alias("_value"))
    return (
        df.join(lookup, F.col(id_column) == F.col("_key"), "left")
        .withColumn(out, F.coalesce("_value", unknown_heading(F.col(id_column), unknown)))
        .drop("_key", "_value")
    )


def collapse_unknown(
    df: DataFrame, known: DataFrame, column: str = "heading", out: str = "heading_eval", other: str = OTHER
) -> DataFrame:
    """Keep the truth where ``known`` lists it, else ``other``."""
    lookup = known.select(F.col(column).alias("_key")).distinct()
    filled = F.coalesce(F.col(column), F.lit(""))
    return (
        df.join(lookup, filled == F.col("_key"), "left")
        .withColumn(out, F.coalesce("_key", F.lit(other)))
        .drop("_key")
    )


def heading_array(
    labels: DataFrame, column: str = "heading", id_column: str = "label_id", value: Callable[[Column], Column] = lambda h: h
) -> Column:
    """The headings at the places of their ids, as one scalar for every row; NULL where an id is missing.

    ``value`` makes something else of each heading, once. The array is as long as the largest id, which each row's own score vector exceeds.
    Two headings for one id are an error.
    """
    id_text = F.concat(F.lit("two headings have the id "), F.col("_id").cast("string"))
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(id_text).cast("string")).otherwise(F.first("_heading"))
    known = (
        labels.select(F.col(id_column).cast("int").alias("_id"), F.col(column).alias("_heading"))
        .filter(F.col("_id") >= 0)
        .groupBy("_id")
        .agg(one.alias("_heading"))
    )
    slots = known.agg(F.max("_id").alias("_last")).select(F.explode(F.sequence(F.lit(0), "_last")).alias("_id"))
    pairs = F.sort_array(F.collect_list(F.struct("_id", "_heading")))
    whole = slots.join(known, "_id", "left").agg(F.transform(pairs, lambda p: value(p["_heading"])).alias("headings"))
    return whole.scalar()


def decode_candidates(
    df: DataFrame, ranked: str, labels: DataFrame, out: str = "candidates", unknown: str = "{}"
) -> DataFrame:
    """Add the ranked classes of the column ``ranked`` with headings in place of ids."""
    return (
        df.withColumn("_headings", heading_array(labels))
        .withColumn(out, decode_classes(F.col(ranked), F.col("_headings"), unknown))
        .drop("_headings")
    )
