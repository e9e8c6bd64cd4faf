"""Working tables in the folder that all executors share, and their end."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from headingflow.sources.shared import new_path

__all__ = ["drop", "new_path", "small_batches", "written"]


#: Rows that Spark sends to a Python worker at once while a table is written.
ROWS_AT_ONCE = 2_000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Texts go to Python some megabytes at a time, unless the session wants fewer rows still."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    spark.conf.set(name, str(min(before, ROWS_AT_ONCE) if before > 0 else ROWS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The table, written to the shared folder and read back, and its path for ``drop``."""
    path = new_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete working tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
