"""Checks that fail before or instead of a wrong result."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"Missing columns: {missing}. Found: {df.columns}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("No rows found.")
    return df


def with_default(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add the column only where it is absent."""
    return df if name in df.columns else df.withColumn(name, value)


def require_known(df: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Fail with all sorted values of ``column`` that ``known`` lacks, joined to one text by Spark."""
    unknown = unseen_values(df, known, column)
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(column)), lambda v: F.concat(F.lit("'"), v, F.lit("'"))), ", ")
    found = unknown.agg(F.count(F.lit(1)).alias("n"), listed.alias("listed")).first()
    if found["n"]:
        raise ValueError(f"Unseen {column}: [{found['listed']}] ({found['n']})")
    return df


def unseen_values(df: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` absent from ``known``, NULL read as ``""``."""
    values = df.select(F.coalesce(F.col(column), F.lit("")).alias(column)).distinct()
    return values.join(known.select(column).distinct(), column, "left_anti")


def report_ks(ks: Sequence[int], max_k: int) -> list[int]:
    """Sorted distinct ks, none above ``max_k``."""
    wanted = sorted({int(k) for k in ks})
    if not wanted:
        raise ValueError("no k to report")
    if wanted[0] < 1:
        raise ValueError(f"k must be at least 1, got {wanted[0]}")
    if wanted[-1] > max_k:
        raise ValueError(f"largest k {wanted[-1]} exceeds the {max_k} candidates made")
    return wanted


def require_topk(k: int) -> int:
    if int(k) < 1:
        raise ValueError("topk must be >= 1")
    return int(k)


def clamp_topk(k: int, upper: int | None = None) -> int:
    """At least 1, and at most ``upper`` where one is given (the upload flow takes 10)."""
    return max(1, int(k) if upper is None else min(int(k), upper))
