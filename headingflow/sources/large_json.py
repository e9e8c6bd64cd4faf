"""Items of JSON documents of any size, and of documents with faults.

A document is cut at the items of its list by byte ranges, so a file that is one
huge list is read by many tasks, and no task holds more than an item. What an
item holds is parsed afterwards, one item at a time: one that cannot be read is
put aside with the reason and costs no other.
"""

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headingflow.operators.canon import ENVELOPE_KEYS, extract_questions
from headingflow.sources.byte_ranges import before, entered, file_names, fragments, joined_parts, scan
from headingflow.sources.shared import materialise

#: Fragments end in this sign, so none ends inside an escape.
SEPARATOR = "}"
_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_SIGN = re.compile(rb"[\[\]{},]")
_BLANK = b" \t\r\n"


def outside_strings(data: bytes, inside: bool) -> tuple[list[tuple[int, bytes]], bool]:
    """The parts of a fragment that are in no string, with their places; and whether it ends in one."""
    parts = _ESCAPE.sub(b"  ", data).split(b'"')
    found, at = [], 0
    for part in parts:
        if not inside:
            found.append((at, part))
        at += len(part) + 1
        inside = not inside
    return found, not inside


class RangeSum:
    """Sums a range up: its first sign, and the change of depth and the end state for either state at its start."""

    SCHEMA = "first string, depth_out long, ends_out boolean, depth_in long, ends_in boolean"

    def __init__(self):
        self.first = b""
        self.depth = [0, 0]
        self.inside = [False, True]

    def feed(self, fragment: bytes) -> list[tuple]:
        data = fragment + b"}"
        self.first = self.first or data.removeprefix(b"\xef\xbb\xbf").lstrip(_BLANK)[:1]
        parts = _ESCAPE.sub(b"  ", data).split(b'"')
        nested = [
            sum(p.count(b"{") + p.count(b"[") - p.count(b"}") - p.count(b"]") for p in parts[k::2]) for k in (0, 1)
        ]
        for k in (0, 1):
            self.depth[k] += nested[self.inside[k]]
            self.inside[k] ^= len(parts) % 2 == 0
        return []

    def finish(self) -> list[tuple]:
        return [(self.first.decode("latin-1"), self.depth[0], self.inside[0], self.depth[1], self.inside[1])]


def _after(state: tuple, row: dict) -> tuple:
    inside, depth = state
    more, ends = (row["depth_in"], row["ends_in"]) if inside else (row["depth_out"], row["ends_out"])
    return ends, depth + more


class ItemCutter:
    """Cuts a range at the commas and brackets of ``level``; what is above it is the skeleton of the document.

    ``ordinal`` numbers the brackets opened on that level in the range, -1 for
    one opened before; ``item`` the items that begin in the range after it.
    """

    SCHEMA = "kind string, seq long, ordinal long, item long, last boolean, text binary"

    def __init__(self, inside: bool, depth: int, level: int):
        self.inside, self.depth, self.level = inside, depth, level
        self.over = False
        self.ordinal, self.item, self.seq = -1, -1, 0
        self.started = False
        self.held: list[bytes] = []
        self.skeleton: list[bytes] = []

    def _row(self, kind: str, last: bool = False) -> tuple:
        self.seq += 1
        text, self.held = b"".join(self.held), []
        return kind, self.seq, self.ordinal, self.item, last, text

    def _end(self, last: bool) -> tuple:
        return self._row("whole" if self.started else "head", last)

    def _begin(self) -> None:
        self.started = True
        self.item += 1

    def feed(self, fragment: bytes) -> list[tuple]:
        data = fragment + b"}"
        out: list[tuple] = []
        parts, self.inside = outside_strings(data, self.inside)
        at = 0
        for place, part in parts:
            for found in _SIGN.finditer(part):
                sign, here = found.group(), place + found.start()
                if self.over:
                    break
                if sign in b"[{":
                    self.depth += 1
                    if self.depth == self.level:
                        self.skeleton.append(data[at : here + 1])
                        at = here + 1
                        self.ordinal, self.item = self.ordinal + 1, -1
                        self._begin()
                elif self.depth <= 0:
                    self.over = True
                elif sign in b"]}":
                    if self.depth == self.level:
                        self.held.append(data[at:here])
                        at = here
                        out.append(self._end(last=True))
                    self.depth -= 1
                    if self.depth <= 0:
                        self.skeleton.append(data[at : here + 1])
                        at = here + 1
                        self.over = True
                elif self.depth == self.level:
                    self.held.append(data[at:here])
                    at = here + 1
                    out.append(self._end(last=False))
                    self._begin()
        rest = data[at:]
        if self.over:
            # The last sign of a file may be one that was put there.
            self.skeleton.append(rest.strip(_BLANK + b"}"))
        else:
            (self.held if self.depth >= self.level else self.skeleton).append(rest)
        return out

    def finish(self) -> list[tuple]:
        out = []
        if self.depth >= self.level and not self.over:
            out.append(self._row("tail" if self.started else "middle"))
        self.held = self.skeleton
        return [*out, self._row("skeleton")]


def list_in(skeleton: bytes, keys: Sequence[str]) -> tuple[int | None, str | None]:
    """Which bracket of the skeleton opens the list of items, by its number; or why there is none."""
    count = 0

    class Members(list):
        pass

    # Brackets one level down are empty and numbered in their order.
    def numbered(pairs):
        return Members(pairs)

    try:
        root = json.loads(skeleton.removeprefix(b"\xef\xbb\xbf"), object_pairs_hook=numbered)
    except (ValueError, RecursionError) as fault:
        return None, f"the document is not JSON: {getattr(fault, 'msg', fault)}"
    if not isinstance(root, Members):
        return (0, None) if isinstance(root, list) else (None, "the document is not a list and holds none")
    lists: dict[str, int | None] = {}
    for key, value in root:
        lists[key] = count if isinstance(value, list) and not isinstance(value, Members) else None
        count += isinstance(value, list)
    for key in keys:
        if lists.get(key) is not None:
            return lists[key], None
    return None, "the document is not a list and holds none"


def _located(table: pa.Table, keys: Sequence[str]) -> pa.Table:
    """For each range of a file the number, among the brackets it opens, of that of the items."""
    rows = sorted(table.to_pylist(), key=lambda r: r["start"])
    skeleton = b"".join(r["text"] for r in rows)
    chosen, reason = list_in(skeleton, keys)
    if reason:  # of a document that is cut off the items so far are read
        for end in (b"]", b"]}"):
            if list_in(skeleton + end, keys)[1] is None:
                chosen, reason = list_in(skeleton + end, keys)
    out, opened = [], 0
    for row in rows:
        local = None if chosen is None else chosen - opened
        out.append({"file": row["file"], "start": row["start"], "wanted": local, "reason": reason})
        opened += row["ordinal"] + 1
    kinds = [("file", pa.int64()), ("start", pa.int64()), ("wanted", pa.int64()), ("reason", pa.string())]
    return pa.Table.from_pylist(out, schema=pa.schema(kinds))


@dataclass
class Items:
    """``items``: document, position, item (text). ``rejects``: document, position, reason, text."""

    items: DataFrame
    rejects: DataFrame


def read_items(spark: SparkSession, path: str, keys: Sequence[str] = ENVELOPE_KEYS) -> Items:
    """The items of every document below ``path``, one document a file, as text.

    A document is a list, or an object in which the first of ``keys`` whose
    value is a list holds the items. One that is neither, whose envelope cannot
    be read, or that ends inside an item is among the rejects. Spark does not
    read files of no bytes at all; they have no row in either table.
    """
    whole = fragments(spark, path, SEPARATOR)
    sums = materialise(scan(whole, RangeSum, RangeSum.SCHEMA), "range-sums")
    entry = entered(sums, _after, (False, 0), "inside boolean, depth long")
    # The items of an object are two levels down, in one of its lists.
    level = sums.filter("start = 0").select("file", F.when(F.col("first") == "{", 2).otherwise(1).alias("level"))
    # One row for each range of bytes, or for each file.
    entry = entry.join(F.broadcast(level), "file")
    ready = whole.join(F.broadcast(materialise(entry, "range-states")), ["file", "start"])
    pieces = materialise(scan(ready, ItemCutter, ItemCutter.SCHEMA), "json-pieces")

    skeletons = pieces.filter("kind = 'skeleton'").select("file", "start", "ordinal", "text")
    ranges = materialise(
        skeletons.groupBy("file").applyInArrow(
            lambda table: _located(table, keys), "file long, start long, wanted long, reason string"
        ),
        "json-ranges",
    )
    cut = pieces.filter("kind <> 'skeleton'").join(F.broadcast(ranges.drop("reason")), ["file", "start"])
    wanted = F.col("ordinal") == F.col("wanted")
    begun = cut.filter(F.col("kind").isin("whole", "tail") & wanted).groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"))
    counts = ranges.select("file", "start").join(begun, ["file", "start"], "left")
    offsets = counts.select("file", "start", before(F.col("n")).alias("_before"))

    across = joined_parts(cut.filter("kind IN ('tail', 'middle', 'head')"))
    columns = ["file", "start", "ordinal", "wanted", "item", "last", "text", "ended"]
    listed = cut.filter("kind = 'whole'").withColumn("ended", F.lit(True)).select(*columns).unionByName(across.select(*columns))
    # A blank before a closing bracket is an empty list, or a comma too many.
    blank = F.col("last") & (F.btrim(F.col("text").cast("string"), F.lit(" \t\r\n")) == "")
    names = F.broadcast(file_names(spark, path))  # one row for each file
    placed = (
        listed.filter(wanted & ~(F.col("ended") & blank))
        .join(F.broadcast(materialise(offsets, "json-offsets")), ["file", "start"])
        .join(names, "file")
        .select(
            "document", (F.col("_before") + F.col("item")).alias("position"), F.col("text").cast("string").alias("item"), "ended"
        )
    )
    faults = ranges.filter("start = 0 AND reason IS NOT NULL").join(names, "file").select("document", "reason")
    empty = F.lit(None)
    rejects = placed.filter("NOT ended").select(
        "document", "position", F.lit("the document ends inside the item").alias("reason"), F.col("item").alias("text")
    )
    return Items(
        placed.filter("ended").drop("ended"),
        rejects.unionByName(
            faults.select("document", empty.cast("long").alias("position"), "reason", empty.cast("string").alias("text"))
        ),
    )


def _reread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items that are not strict JSON: what a tolerant reader makes of them, or why it cannot."""
    for batch in batches:
        values: list[str | None] = []
        reasons: list[str | None] = []
        for item in batch.column("item"):
            try:
                # Of repeated keys the last wins; NaN and the infinities become texts.
                read = json.loads(item.as_py(), parse_constant=str)
                values.append(json.dumps(read))
                reasons.append(None)
            except (ValueError, RecursionError) as fault:
                values.append(None)
                reasons.append(f"the item is not JSON: {getattr(fault, 'msg', fault)}")
        others = [batch.column(c) for c in ("document", "position", "item")]
        yield pa.RecordBatch.from_arrays(
            [*others, pa.array(values, pa.string()), pa.array(reasons, pa.string())],
            names=["document", "position", "item", "value", "reason"],
        )


def parse_items(found: Items) -> Items:
    """The items as strict JSON, and all that cannot be read.

    Repeated keys and ``NaN``, ``Infinity`` and ``-Infinity`` are accepted; only
    items with such faults leave the JVM.
    """
    items = materialise(found.items, "json-items")
    fault = F.try_parse_json("item").isNull()
    schema = "document string, position long, item string, value string, reason string"
    again = materialise(items.filter(fault).mapInArrow(_reread, schema), "json-reread")
    readable = again.filter(F.try_parse_json("value").isNotNull())
    good = items.filter(~fault).unionByName(readable.select("document", "position", F.col("value").alias("item")))
    reason = F.coalesce("reason", F.lit("the item cannot be held as a JSON value"))
    bad = again.filter(F.try_parse_json("value").isNull()).select(
        "document", "position", reason.alias("reason"), F.col("item").alias("text")
    )
    return Items(good, found.rejects.unionByName(bad))


def read_questions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The complete questions of documents of any size, and the table of rejects.

    The first equals ``extract_questions`` of the documents, with ``document``
    beside each row; the second counts what could not be read.
    """
    parsed = parse_items(read_items(spark, path))
    alone = parsed.items.select("document", F.col("position").alias("_at"), F.concat(F.lit("["), "item", F.lit("]")).alias("value"))
    rows = extract_questions(alone).drop("position").withColumnRenamed("_at", "position")
    return rows.select("document", "position", "question", "heading", "department", "date"), parsed.rejects
