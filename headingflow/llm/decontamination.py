"""Benchmark passages in documents by the q-gram lemma: count in diagonal bands, then align.

An item is searched by its segments. A segment of m characters that occurs with
at most e edits shares at least ``m - q + 1 - q * e`` q-grams with its place, all
on diagonals (place in the text less place in the segment) that differ by e at
most. So shared q-grams are counted in diagonal bands of width 2 e that overlap
by half; only bands that reach the bound are aligned.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headingflow.llm.storage import drop, new_path

Q = 7
#: Edits for each character of a segment.
EDITS = 0.10
#: Characters of a segment, about; an item shorter than twice that is one segment.
SEGMENT = 100
#: Characters of items that are searched for in one pass over the documents: what is broadcast is some 40 bytes for each.
BLOCK = 1 << 21
#: Segments in a block, and documents searched at once, at most: their numbers share 64 bits with the band.
MOST_SEGMENTS, MOST_DOCUMENTS = 1 << 17, 1 << 14
#: Characters of documents that are searched at once, but for a longer document.
RUN = 1 << 19
#: Pairs of equal q-grams that are counted at once, about, and bands aligned at once.
PAIRS, TOGETHER = 1 << 18, 1 << 11
_FACTOR = 0x9E3779B97F4A7C15
_SIEVE_BITS = 22


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case, each run of white space as one space, and the place of each in the text."""
    low = text.lower()
    if len(low) != len(text):  # a few letters become two
        low = "".join(c.lower()[:1] for c in text)
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    white = (points == 32) | ((points >= 9) & (points <= 13)) | (points == 0xA0) | (points == 0x3000)
    kept = np.flatnonzero(~white | np.concatenate([[True], ~white[:-1]]))
    return np.where(white[kept], np.uint32(32), points[kept]), kept


def gram_codes(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit code for the q-gram at each place."""
    n = len(points) - q + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    wide = points.astype(np.uint64)
    codes = wide[:n].copy()
    for j in range(1, q):
        codes *= np.uint64(_FACTOR)
        codes += wide[j : j + n]
    return codes * np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Segment:
    item: object
    number: int
    points: np.ndarray
    edits: int
    bound: int


def segments_of(item: object, text: str, segment: int = SEGMENT, edits: float = EDITS, q: int = Q) -> list[Segment]:
    """Parts of about equal length; the edits are lowered where the bound would not be positive."""
    points, _ = normal(text.strip())
    if len(points) < q:
        return []
    n = max(1, len(points) // segment)
    cuts = [len(points) * i // n for i in range(n + 1)]
    found = []
    for number, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
        m = end - start
        allowed = min(int(edits * m), max(0, (m - q) // q))
        found.append(Segment(item, number, points[start:end], allowed, m - q + 1 - q * allowed))
    return found


class GramIndex:
    """The q-grams of a block of segments: sorted codes with their segments and places, and a sieve in front."""

    def __init__(self, segments: list[Segment], q: int = Q):
        self.segments, self.q = segments, q
        codes = [gram_codes(s.points, q) for s in segments]
        owners = np.repeat(np.arange(len(segments)), [len(c) for c in codes])
        places = np.concatenate([np.arange(len(c)) for c in codes] or [np.zeros(0, dtype=np.int64)])
        flat = np.concatenate(codes or [np.zeros(0, dtype=np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.codes, self.first, self.n = np.unique(flat[order], return_index=True, return_counts=True)
        self.owners, self.places = owners[order].astype(np.int32), places[order].astype(np.int32)
        self.sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
        self.sieve[self.codes >> np.uint64(64 - _SIEVE_BITS)] = True
        self.width = max(2, 2 * max((s.edits for s in segments), default=1))
        self.bounds = np.array([s.bound for s in segments], dtype=np.int64)

    def bands(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rows of document, segment and first diagonal of the bands that reach the bound.

        ``points`` are the documents that begin at ``starts``; diagonals count from there.
        """
        codes = gram_codes(points, self.q)
        at = np.flatnonzero(self.sieve[codes >> np.uint64(64 - _SIEVE_BITS)])
        if not len(at) or not len(self.codes):
            return np.zeros((0, 3), dtype=np.int64)
        slot = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        same = self.codes[slot] == codes[at]
        at, slot = at[same], slot[same]
        times = self.n[slot]
        doc = np.searchsorted(starts, at, side="right") - 1
        offset = 1 << 20  # longer than any segment
        shifts = (0, self.width // 2)
        total = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in shifts]
        # A q-gram that text and items repeat meets many places; pairs are counted some at a time.
        done = np.cumsum(times)
        cuts = np.searchsorted(done, np.arange(PAIRS, done[-1] if len(done) else 0, PAIRS), side="left") + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
            if low >= high:
                continue
            some, n = slice(low, high), times[low:high]
            place = np.repeat(self.first[slot[some]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            diagonal = np.repeat(at[some] - starts[doc[some]] + offset, n) - self.places[place]
            who = np.repeat(doc[some] << 17, n) | self.owners[place]
            for k, shift in enumerate(shifts):
                total[k] = _added(*total[k], *np.unique(who << 32 | (diagonal + shift) // self.width, return_counts=True))
        found = []
        for shift, (keys, counts) in zip(shifts, total, strict=True):
            keys = keys[counts >= self.bounds[keys >> 32 & (1 << 17) - 1]]
            first = (keys & (1 << 32) - 1) * self.width - shift - offset
            found.append(np.stack([keys >> 49, keys >> 32 & (1 << 17) - 1, first], axis=1))
        return np.concatenate(found)


def _added(keys: np.ndarray, counts: np.ndarray, more: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of sorted keys, put together."""
    if not len(keys):
        return more, n
    both, place = np.unique(np.concatenate([keys, more]), return_inverse=True)
    total = np.zeros(len(both), dtype=np.int64)
    total[place[: len(keys)]] = counts
    total[place[len(keys) :]] += n
    return both, total


def aligned(segment: np.ndarray, text: np.ndarray, edits: int, width: int) -> tuple[int, int, int] | None:
    """Fewest edits of the segment against a part of the text, and the part, or None above ``edits``.

    The text is what the diagonals of a band, and ``edits`` more on either side,
    reach. Cell k of a row stands on diagonal k, so a row is the band and no more.
    """
    return aligned_all([(segment, text, edits)], width)[0]


def aligned_all(cases: list[tuple[np.ndarray, np.ndarray, int]], width: int) -> list[tuple[int, int, int] | None]:
    """``aligned`` of many cases ``(segment, text, edits)`` at once, one row of all bands after the other."""
    none = 1 << 20
    order = sorted(range(len(cases)), key=lambda c: -len(cases[c][0]))
    lengths = np.array([len(cases[c][0]) for c in order])
    ends = np.array([len(cases[c][1]) for c in order])
    limits = np.array([cases[c][2] for c in order], dtype=np.int32)
    sizes = width + 2 * limits + 1
    size, longest = int(sizes.max()), int(lengths[0])
    texts = np.full((len(cases), longest + size), 0xFFFFFFFF, dtype=np.uint32)
    segments = np.zeros((len(cases), longest), dtype=np.uint32)
    for row, c in enumerate(order):
        segment, text, _ = cases[c]
        segments[row, : len(segment)] = segment
        texts[row, : len(text)] = text[: longest + size]
    places = np.arange(size, dtype=np.int32)
    outside = places >= sizes[:, None]
    cost = np.where(outside, none, 0).astype(np.int32)
    begin = np.broadcast_to(places, cost.shape).copy()  # where in the text the best way to each cell began
    which = np.array(order)
    out: list[tuple[int, int, int] | None] = [None] * len(cases)
    for i in range(longest):
        step = cost + (texts[:, i : i + size] != segments[:, i, None])
        start = begin.copy()
        # From the diagonal above: the segment's character is left out.
        over, source = cost[:, 1:] + 1, begin[:, 1:]
        better = over < step[:, :-1]
        np.copyto(step[:, :-1], over, where=better)
        np.copyto(start[:, :-1], source, where=better)
        # Along the row: characters of the text are left out.
        flat = step - places
        least = np.minimum.accumulate(flat, axis=1)
        from_left = np.maximum.accumulate(np.where(flat == least, places, -1), axis=1)
        begin = np.take_along_axis(start, from_left, axis=1)
        cost = np.where(outside, none, least + places)
        ended = int(np.searchsorted(-lengths, -(i + 1), side="left"))
        for row in range(ended, len(which)):
            m = i + 1
            usable = np.where(places + m <= ends[row], cost[row], none)
            k = int(usable.argmin())
            if usable[k] <= limits[row]:
                out[which[row]] = (int(usable[k]), int(begin[row, k]), k + m)
        stays = np.arange(len(which)) < ended
        if i % 8 == 7:
            stays &= cost.min(axis=1) <= limits
        if not stays.all():
            cost, begin, texts, segments, outside = (x[stays] for x in (cost, begin, texts, segments, outside))
            which, lengths, ends, limits = (x[stays] for x in (which, lengths, ends, limits))
        if not len(which):
            break
    return out


def _matches(index: GramIndex, batch: list[tuple]) -> Iterator[tuple]:
    """Rows of the matches in documents given as ``(id, points, places)``."""
    gap = np.full(1, 0x110000, dtype=np.uint32)  # no character
    joined = np.concatenate([x for _, points, _ in batch for x in (points, gap)])
    starts = np.cumsum([0] + [len(points) + 1 for _, points, _ in batch])[:-1]
    seen: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    bands = index.bands(joined, starts)
    for at in range(0, len(bands), TOGETHER):
        cases = []
        lows = []
        some = bands[at : at + TOGETHER].tolist()
        for doc, owner, diagonal in some:
            segment, points = index.segments[owner], batch[doc][1]
            low = diagonal - segment.edits
            window = points[max(0, low) : diagonal + index.width + len(segment.points) + segment.edits]
            if low < 0:  # what is left out before the text's first character leads to diagonals below 0
                window = np.concatenate([np.repeat(gap, -low), window])
            cases.append((segment.points, window, segment.edits))
            lows.append(low)
        for (doc, owner, _), low, made in zip(some, lows, aligned_all(cases, index.width), strict=True):
            if made:
                edits, begin, end = made[0], max(0, low + made[1]), low + made[2]
                spans = seen.setdefault((doc, owner), [])
                if all(begin >= e or end <= s for _, s, e in spans):
                    spans.append((edits, begin, end))
    for (doc, owner), spans in sorted(seen.items()):
        key, _, places = batch[doc]
        for edits, start, end in spans:
            segment = index.segments[owner]
            yield key, segment.item, segment.number, int(places[start]), int(places[end - 1]) + 1, edits


def write_segments(items: DataFrame, block: int, segment: int, edits: float) -> str:
    """The segments of all items in a table by ``_block``; a block is small enough for one index."""
    size = items.agg(F.sum(F.length("_text")).alias("n")).first()["n"] or 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number, chars, count = task.partitionId() << 32, 0, 0
        for batch in batches:
            for i, text in enumerate(batch.column("_text")):
                made = segments_of(None, text.as_py(), segment, edits)
                blocks = []
                for s in made:
                    if chars >= block or count >= MOST_SEGMENTS:
                        number, chars, count = number + 1, 0, 0
                    chars, count = chars + len(s.points), count + 1
                    blocks.append(number)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(blocks, pa.int64()),
                        batch.column("_item").take(pa.array([i] * len(made), pa.int64())),
                        pa.array([s.number for s in made], pa.int32()),
                        pa.array([s.points.astype("<u4").tobytes() for s in made], pa.binary()),
                        pa.array([s.edits for s in made], pa.int32()),
                        pa.array([s.bound for s in made], pa.int32()),
                    ],
                    names=["_block", "_item", "number", "points", "edits", "bound"],
                )

    kind = items.schema["_item"].dataType.simpleString()
    path = new_path(items.sparkSession, "segments")
    schema = f"_block long, _item {kind}, number int, points binary, edits int, bound int"
    items.repartition(max(1, -(-size // block))).mapInArrow(cut, schema).write.partitionBy("_block").parquet(path)
    return path


def find_passages(
    df: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    segment: int = SEGMENT,
    edits: float = EDITS,
    block: int = BLOCK,
) -> DataFrame:
    """``id_column, item_id, segment, start, end, edits``: where items, or whole segments of them, occur.

    ``start`` and ``end`` are character offsets of the text. Case and the length
    of white space do not count. Every document is compared with every item, in
    blocks of items of a bounded size: one pass over the documents for each
    block, nothing shuffled. A block's segments, and no more, come to the driver,
    which indexes them and lets go of them when the matches are written. Of
    overlapping places of a segment one is given. Very long texts and texts that
    repeat themselves take time, but no more memory: pairs of equal q-grams are
    counted, and bands aligned, a bounded number at a time.

    NULL and empty texts have no matches, nor have items of fewer than seven
    characters; a NULL item text is left out. NULL ids are carried through,
    repeated rows give their matches each, equal items match both. Without items
    the result is empty. Other columns are neither read nor returned.
    """
    spark = df.sparkSession
    kind = df.schema[id_column].dataType.simpleString()
    item_kind = benchmark.schema[item_column].dataType.simpleString()
    schema = f"{id_column} {kind}, item_id {item_kind}, segment int, start long, end long, edits int"
    items = benchmark.select(F.col(item_column).alias("_item"), F.col(item_text_column).alias("_text")).dropna(
        subset=["_text"]
    )
    rows = df.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    rows = rows.filter(F.length("_text") > 0)
    path = new_path(spark, "passages")
    spark.createDataFrame([], schema).write.parquet(path)
    segments_path = write_segments(items, block, segment, edits)
    table = spark.read.schema(
        f"_block long, _item {item_kind}, number int, points binary, edits int, bound int"
    ).parquet(segments_path)
    # One number for each block, then the segments of one block at a time.
    for number in sorted(r["_block"] for r in table.select("_block").distinct().collect()):
        held = [
            Segment(r["_item"], r["number"], np.frombuffer(bytes(r["points"]), "<u4"), r["edits"], r["bound"])
            for r in table.filter(F.col("_block") == number).collect()
        ]
        index = spark.sparkContext.broadcast(GramIndex(held))
        _search(rows, index, schema).write.mode("append").parquet(path)
        index.destroy()
    drop(spark, segments_path)
    return spark.read.schema(schema).parquet(path)


def _search(rows: DataFrame, shared, schema: str) -> DataFrame:
    empty = rows.sparkSession.createDataFrame([], schema)
    names = empty.columns

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = shared.value
        for batch in batches:
            kinds = [batch.schema.field("_id").type, item_type, pa.int32(), pa.int64(), pa.int64(), pa.int32()]
            held: list[tuple] = []
            size = 0
            made: list[tuple] = []
            for key, text in zip(batch.column("_id"), batch.column("_text"), strict=True):
                points, places = normal(text.as_py())
                held.append((key.as_py(), points, places))
                size += len(points)
                if size >= RUN or len(held) == MOST_DOCUMENTS:
                    made += _matches(grams, held)
                    held, size = [], 0
            if held:
                made += _matches(grams, held)
            columns = list(zip(*made, strict=True)) if made else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    item_type = to_arrow_type(empty.schema["item_id"].dataType)
    return rows.mapInArrow(search, empty.schema)
