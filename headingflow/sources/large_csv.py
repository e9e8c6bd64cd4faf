"""CSV files with texts over several lines, read in byte ranges.

A line break ends a record if the quotes before it are even in number. Each
range counts its quotes, the sums of the ranges before it say whether it begins
inside a quoted text, and then every range finds its records by itself.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from headingflow.functions.text import quoted
from headingflow.sources.byte_ranges import entered, fragments, joined_parts, scan
from headingflow.sources.shared import materialise


class QuoteSum:
    """Whether a range has an odd number of quotes. A quote in a text is written twice."""

    SCHEMA = "odd boolean"

    def __init__(self):
        self.odd = False

    def feed(self, fragment: bytes) -> list[tuple]:
        self.odd ^= fragment.count(b'"') % 2 == 1
        return []

    def finish(self) -> list[tuple]:
        return [(self.odd,)]


class RecordCutter:
    """Puts the lines of a range together to records; ``item`` numbers those that begin in it."""

    SCHEMA = "kind string, seq long, item long, last boolean, text binary"

    def __init__(self, inside: bool):
        self.inside = inside
        self.started = False
        self.item, self.seq = -1, 0
        self.held: list[bytes] = []

    def _row(self, kind: str) -> tuple:
        text, self.held = b"\n".join(self.held), []
        if kind in ("tail", "middle"):
            text += b"\n"
        self.seq += 1
        return kind, self.seq, self.item, False, text.removesuffix(b"\r") if kind in ("whole", "head") else text

    def feed(self, fragment: bytes) -> list[tuple]:
        if not self.inside:
            self.started = True
            self.item += 1
        self.held.append(fragment)
        self.inside ^= fragment.count(b'"') % 2 == 1
        return [] if self.inside else [self._row("whole" if self.started else "head")]

    def finish(self) -> list[tuple]:
        return [self._row("tail" if self.started else "middle")] if self.held else []


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, item, record``: the records of all files as text, with the header of each."""
    lines = fragments(spark, path, "\n")
    sums = materialise(scan(lines, QuoteSum, QuoteSum.SCHEMA), "range-quotes")
    entry = entered(sums, lambda state, row: (state[0] ^ row["odd"],), (False,), "inside boolean")
    # One row for each range of bytes.
    ready = lines.join(F.broadcast(materialise(entry, "range-states")), ["file", "start"])
    pieces = materialise(scan(ready, RecordCutter, RecordCutter.SCHEMA), "csv-pieces")
    across = joined_parts(pieces.filter("kind <> 'whole'"))
    columns = ["file", "start", "item", F.col("text").cast("string").alias("record")]
    records = pieces.filter("kind = 'whole'").select(*columns).unionByName(across.select(*columns))
    return records.filter("record <> ''")


def read_csv_ranges(
    spark: SparkSession, path: str, schema: StructType | str, missing: Sequence[str] = ("",)
) -> DataFrame:
    """What ``read_csv`` reads, but a single file is read by many tasks.

    Every file begins with a header, which must name the columns of the schema
    in their order. Strings in ``missing`` become NULL.
    """
    kinds = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    records = read_records(spark, path)
    header = (F.col("start") == 0) & (F.col("item") == 0)
    texts = StructType().fromDDL(", ".join(f"{quoted(f.name)} string" for f in kinds))
    bare = F.regexp_replace("record", "^﻿", "")
    named = records.filter(header).select(F.from_csv(bare, texts.toDDL(), options).alias("h"))
    differs = [~F.col("h")[f.name].eqNullSafe(f.name) for f in kinds]
    wrong = named.filter(F.array_contains(F.array(*differs), True)).first()
    if wrong:
        raise ValueError(f"the header of a file is {list(wrong['h'])}, not {kinds.names}")
    rows = records.filter(~header).select(F.from_csv("record", kinds.toDDL(), options).alias("r")).select("r.*")
    return rows.select(
        *[
            F.when(~F.col(quoted(f.name)).isin(list(missing)), F.col(quoted(f.name))).alias(f.name)
            if isinstance(f.dataType, StringType) and missing
            else F.col(quoted(f.name))
            for f in kinds
        ]
    )
