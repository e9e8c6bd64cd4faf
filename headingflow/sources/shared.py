"""The folder that all executors share, and tables written into it."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder from ``spark.checkpoint.dir``, else one below the warehouse.

    Both are shared by all executors, whatever the master.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared").rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/headingflow/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write the table to the shared folder and read it back.

    The copy survives lost executors, cuts the lineage and has a known size: a
    join with it is broadcast only where the files are below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffled otherwise, and the
    facts on the other side are not shuffled while that size is still unknown.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialise`` wrote and nothing reads any more."""
    spark = df.sparkSession
    for file in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(file)
        if "/headingflow/" not in file:
            raise ValueError(f"{file} is no intermediate table")
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def spread(scan: DataFrame) -> DataFrame:
    """Give every core a part of a scan that has fewer parts than there are cores.

    For heavy work per row on a few files, or on one large row group. A large
    table has more parts than that and passes unchanged, so it is never
    shuffled here. Meant for scans and projections of them: asking a plan with
    a shuffle for its parts would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
