"""Exact stratified train and validation split that no hot label can stall."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headingflow.sources.shared import materialise

VALIDATION_SHARE = 0.1
SEED = 42
# Hex digits of the hash that form a bucket: 65,536 buckets per label.
_BUCKET_DIGITS = 4


def split_rows(
    df: DataFrame,
    id_column: str,
    label: str | None = "heading",
    share: float = VALIDATION_SHARE,
    seed: int = SEED,
    out: str = "split",
) -> DataFrame:
    """Mark each row ``train`` or ``val``; val gets floor(share * n + 0.5) rows of each label.

    The rows of a label come in the order of md5(id, seed), and the first ones
    go to val; so the split depends on ids and seed only. A label with one row
    stays in train. ``label=None`` splits without strata.

    Sorting a label in one task would stall on a label with a third of all
    rows. Instead the rows are counted per label and hash prefix, the prefix in
    which the quota ends is found from the counts, and only the rows in that one
    prefix are ordered. The last step compares each row with its label's cut.
    """
    keyed = df.withColumn("_hash", F.md5(F.concat_ws("|", F.col(id_column).cast("string"), F.lit(str(seed)))))
    keyed = keyed.withColumn("_label", F.lit("") if label is None else F.coalesce(F.col(label), F.lit("")))
    prefix = F.substring("_hash", 1, _BUCKET_DIGITS)
    slim = keyed.select("_label", "_hash", F.col(id_column).alias("_id"), prefix.alias("_prefix"))

    upto = Window.partitionBy("_label").orderBy("_prefix")
    counts = slim.groupBy("_label", "_prefix").agg(F.count(F.lit(1)).alias("n"))
    last = (
        counts.withColumn("upto", F.sum("n").over(upto))
        .withColumn("total", F.sum("n").over(Window.partitionBy("_label")))
        .withColumn("quota", F.floor(F.lit(float(share)) * F.col("total") + 0.5))
        .filter((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota")))
        .select("_label", "_prefix", (F.col("quota") - F.col("upto") + F.col("n")).alias("wanted"))
    )
    last = materialise(last, "split-prefix")

    inside = Window.partitionBy("_label").orderBy("_hash", "_id")
    cuts = (
        slim.join(last, ["_label", "_prefix"])
        .withColumn("place", F.row_number().over(inside))
        .filter(F.col("place") == F.col("wanted"))
        .select("_label", F.col("_hash").alias("_cut_hash"), F.col("_id").alias("_cut_id"))
    )
    cuts = materialise(cuts, "split-cuts")

    before_cut = (F.col("_hash") < F.col("_cut_hash")) | (
        (F.col("_hash") == F.col("_cut_hash")) & (F.col(id_column) <= F.col("_cut_id"))
    )
    return (
        keyed.join(cuts, "_label", "left")
        .withColumn(out, F.when(before_cut, "val").otherwise("train"))
        .select(*df.columns, out)
    )


def split_by_day(df: DataFrame, day: str, first_val_day, out: str = "split") -> DataFrame:
    """Temporal hold-out: rows from ``first_val_day`` on are ``val``."""
    return df.withColumn(out, F.when(F.col(day) >= F.lit(first_val_day), "val").otherwise("train"))
