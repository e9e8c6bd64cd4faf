"""Files cut by what stands between their byte ranges, whatever the ranges.

Spark reads a file in byte ranges, each as the fragments between two separators
that begin in it. Where a fragment belongs, in a quoted text or not, depends on
all that stands before it. So a first pass sums up each range for every state
it may be entered in, a prefix pass over these sums, one row for each range,
gives the state it is entered in, and a second pass cuts the ranges
independently of each other. A record that crosses ranges comes in parts: a
``tail`` where it begins, a ``middle`` for each range it fills, a ``head`` where
it ends.
"""

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of records that a task sends on at once, about.
SENT_BYTES = 4 << 20


class Scanner(Protocol):
    """Walks the fragments of one range in their order; both methods give rows."""

    def feed(self, fragment: bytes) -> list[tuple]: ...

    def finish(self) -> list[tuple]: ...


def fragments(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``file, start, value``: the bytes between separators; ``start`` is where their range begins."""
    rows = spark.read.option("lineSep", separator).text(path)
    return rows.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("value"),
    )


def file_names(spark: SparkSession, path: str) -> DataFrame:
    """``file, document``: the path of each file, whose content is not read."""
    found = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("document"))
    return found.select(F.xxhash64("document").alias("file"), "document")


def scan(rows: DataFrame, scanner: Callable[..., Scanner], schema: str) -> DataFrame:
    """The rows of one scanner for each range, after its ``file`` and ``start``.

    What else a fragment's row holds enters the scanner of the range.
    """
    entry = [c for c in rows.columns if c not in ("file", "start", "value")]
    of = rows.sparkSession.createDataFrame([], f"file long, start long, {schema}").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(of)
        at, walker = None, None
        held: list[tuple] = []
        size = 0

        def sent() -> pa.RecordBatch:
            columns = zip(*held, strict=True) if held else [()] * len(kinds)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds
            )

        for batch in batches:
            places = zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True)
            for i, (place, value) in enumerate(zip(places, batch.column("value"), strict=True)):
                if place != at:
                    if walker:
                        held += [(*at, *row) for row in walker.finish()]
                    at, walker = place, scanner(*[batch.column(c)[i].as_py() for c in entry])
                fragment = value.as_py()
                made = walker.feed(fragment)
                held += [(*at, *row) for row in made]
                size += len(fragment)
                if size > SENT_BYTES and held:
                    yield sent()
                    held, size = [], 0
        if walker:
            held += [(*at, *row) for row in walker.finish()]
        yield sent()

    return rows.mapInArrow(run, of)


def entered(sums: DataFrame, step: Callable[[tuple, dict], tuple], first: tuple, schema: str) -> DataFrame:
    """``file, start`` and the state each range is entered in: ``step(state, sums)`` from range to range of a file."""
    names = [c.split()[0] for c in schema.split(", ")]

    def walk(table: pa.Table) -> pa.Table:
        state, out = first, []
        for row in sorted(table.to_pylist(), key=lambda r: r["start"]):
            out.append(dict(zip(("file", "start", *names), (row["file"], row["start"], *state), strict=True)))
            state = step(state, row)
        return pa.Table.from_pylist(out)

    # One row for each range of a file: a task holds few even of a huge one.
    return sums.groupBy("file").applyInArrow(walk, f"file long, start long, {schema}")


def before(count: Column) -> Column:
    """The sum over the ranges of the file before this one."""
    window = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(count).over(window), F.lit(0))


def joined_parts(pieces: DataFrame) -> DataFrame:
    """Records that cross ranges, put together: the tail's columns, ``text``, and ``ended``, whether there is an end.

    ``pieces`` are the rows of the kinds ``tail``, ``middle`` and ``head``, with
    their ``seq`` in the range; at most two for each range.
    """
    order = Window.partitionBy("file").orderBy("start", "seq")
    numbered = pieces.withColumn("_record", F.sum((F.col("kind") == "tail").cast("int")).over(order))
    others = [c for c in pieces.columns if c not in ("file", "kind", "text", "seq", "last")]
    part = F.sort_array(F.collect_list(F.struct("start", "seq", "text")))
    whole = numbered.groupBy("file", "_record").agg(
        *[F.first(F.when(F.col("kind") == "tail", F.col(c)), ignorenulls=True).alias(c) for c in others],
        F.transform(part, lambda p: p["text"]).alias("_parts"),
        F.max(F.when(F.col("kind") == "head", F.col("last"))).alias("last"),
        F.max((F.col("kind") == "head").cast("int")).alias("ended"),
    )
    text = F.aggregate("_parts", F.lit(b""), lambda held, p: F.concat(held, p))
    return whole.withColumn("text", text).withColumn("ended", F.col("ended") == 1).drop("_parts", "_record")
