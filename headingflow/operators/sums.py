"""Vectors of sums over all rows of a table, one number beside another, for fits whose steps the driver makes."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

#: Whether Spark deletes the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Parts of a vector that are added up by different tasks.
SLICES = 16
#: Rows that get no more entries than this are added to together, an entry of each at a time.
THIN = 12
#: Rows that are added to at once.
AT_ONCE = 1 << 11


def add_grouped(
    out: np.ndarray, rows: np.ndarray, places: np.ndarray, values: np.ndarray, table: np.ndarray, at_once: int = AT_ONCE
) -> None:
    """Add ``values[i] * table[places[i]]`` to ``out[rows[i]]`` for every entry i; the numbers of the rows do not fall.

    Values and table have the same type, in which the products for a row are added up.
    """
    if not len(rows):
        return
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    sizes = np.diff(np.append(starts, len(rows)))
    thin = sizes <= THIN
    for j in range(THIN):
        entries = starts[thin & (sizes > j)] + j
        for at in range(0, len(entries), at_once):
            some = entries[at : at + at_once]
            out[rows[some]] += table[places[some]] * values[some, None]
    starts, sizes = starts[~thin], sizes[~thin]
    if not len(starts):
        return
    held = np.empty((int(sizes.max()), table.shape[1]), table.dtype)
    for at in range(0, len(starts), at_once):
        own = starts[at : at + at_once]
        made = np.empty((len(own), table.shape[1]), table.dtype)
        for i, (start, size) in enumerate(zip(own.tolist(), sizes[at : at + at_once].tolist(), strict=True)):
            table.take(places[start : start + size], axis=0, out=held[:size], mode="clip")
            np.dot(values[start : start + size], held[:size], out=made[i])
        out[rows[own]] += made


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Else the shuffle files of every pass of a fit stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def summed(rows: DataFrame, size: int, add: Callable[[np.ndarray, dict], None]) -> np.ndarray:
    """``add(total, row)`` over all rows: each task's own sums, put together slice by slice in the order of the tasks.

    There are no more tasks than cores, so what they send does not grow with the table.
    """
    kinds = pa.schema([("slice", pa.int64()), ("task", pa.int64()), ("sums", pa.binary())])
    schema = "slice long, task long, sums binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for i in range(len(batch)):
                total = np.zeros(size) if total is None else total
                add(total, {name: batch.column(name)[i].as_py() for name in batch.schema.names})
        if total is not None:
            task = TaskContext.get().partitionId()
            for k, part in enumerate(np.array_split(total, SLICES)):
                yield pa.RecordBatch.from_pylist([{"slice": k, "task": task, "sums": part.tobytes()}], schema=kinds)

    def added(table: pa.Table) -> pa.Table:
        held = sorted(table.to_pylist(), key=lambda r: r["task"])
        sums = sum(np.frombuffer(r["sums"], "<f8") for r in held)
        return pa.Table.from_pylist([{"slice": held[0]["slice"], "task": 0, "sums": sums.tobytes()}], schema=kinds)

    spark = rows.sparkSession
    parts = rows.coalesce(spark.sparkContext.defaultParallelism).mapInArrow(work, schema)
    with shuffles_deleted(spark):
        # One vector of a fixed size comes to the driver.
        held = parts.groupBy("slice").applyInArrow(added, schema).collect()
    out = np.zeros(size)
    ends = np.cumsum([len(part) for part in np.array_split(out, SLICES)])
    for row in held:
        part = np.frombuffer(row["sums"], "<f8")
        out[ends[row["slice"]] - len(part) : ends[row["slice"]]] = part
    return out
