"""Time the queries and print one JSON line.

Every query is run to the end into the ``noop`` sink, so whole results are made
and none is collected.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from headingflow.plans.queries import QUERIES


def main(folder: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("headingflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        # No call site is captured for every expression that Python builds.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # One machine: its own folder serves all, and goes with the run.
        .config("spark.checkpoint.dir", folder)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's compilers before the clock runs, with work that is no query.
    warm = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_custkey").count()
    warm.join(spark.read.parquet(f"{sf_dir}/customer.parquet"), warm.o_custkey == F.col("c_custkey")).write.format(
        "noop"
    ).mode("overwrite").save()

    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "all queries, total wall clock",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    with tempfile.TemporaryDirectory(prefix="headingflow-bench-") as scratch:
        main(scratch)
