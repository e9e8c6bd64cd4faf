"""Ranked lexical search by hashed max-sketches, with whole-number scores.

Each document's terms have impacts, which grow with a term's count and shrink
with the document's length. The index folds them into a sketch: a term's hash
gives it a coordinate, and a coordinate holds the largest impact of its terms,
rounded up. So the sum, over the terms of a query, of the term's weight times
its coordinate is an upper bound of the document's score. A batch of queries is
looked up in all sketches at once; only documents whose bound reaches the score
that the k-th best is known to have are read and scored exactly.
"""

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headingflow.llm.storage import drop, new_path, written

# The ASCII characters of terms (with all others), and the constants of the score.
TERM_CHARACTERS = b"0123456789abcdefghijklmnopqrstuvwxyz"
UNIT, SATURATION, LENGTH_PART = 1_000_000_000, 8, 90

#: Impacts are below ``UNIT / 1000``; a coordinate is one byte, in steps of this.
IMPACT_STEP = 4096
#: Coordinates of a sketch: a power of two, at least twice the distinct terms, between these.
LEAST_WIDTH, MOST_WIDTH = 64, 4096
#: Documents of the highest bounds that are scored to learn what the k-th best reaches.
FIRST_TRIES = 32
#: Terms of items, with repeats, that are looked up in one pass over the sketches.
BLOCK_TERMS = 1 << 15
#: Hashes that a worker remembers, and terms that a task counts before it sends them on.
KNOWN_HASHES, SENT_TERMS = 1 << 18, 1 << 18
#: Coordinates looked up at once, about.
_LOOKED_UP = 1 << 20
#: Parts in which the best rows of an item are found before they are put together.
_PARTS = 256


_TERM_BYTES = bytes(
    b if b >= 128 or b in TERM_CHARACTERS else b + 32 if bytes([b]).isupper() else 32 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8 in order, A to Z in lower case."""
    return (text or b"").translate(_TERM_BYTES).split()


def _utf8(column: pa.Array) -> pa.Array:
    return column.cast(pa.binary())


class Hashes:
    """Hashes of terms; a worker forgets them all when it knows too many."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, terms) -> np.ndarray:
        if len(self.known) > KNOWN_HASHES:
            self.known = {}
        known = self.known
        for t in terms:
            if t not in known:
                known[t] = zlib.crc32(t)
        return np.fromiter((known[t] for t in terms), dtype=np.int64, count=len(terms))


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    return (UNIT * tf) // (1000 * tf + SATURATION * m)


def length_norm(n: int, documents: int, terms: int) -> int:
    """The length of a document as a percentage of the mean, for nine tenths of its weight."""
    return 100 - LENGTH_PART + (LENGTH_PART * n * documents) // terms


def width_for(distinct: int) -> int:
    wanted = LEAST_WIDTH
    while wanted < MOST_WIDTH and wanted < 2 * distinct:
        wanted *= 2
    return wanted


def sketch(counts: Counter, m: int, hashes: Hashes) -> bytes:
    """The coordinatewise maxima of a document's impacts, each rounded up to a step."""
    width = width_for(len(counts))
    folded = np.zeros(width, dtype=np.int64)
    tf = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
    np.maximum.at(folded, hashes(counts.keys()) & (width - 1), impacts(tf, m))
    return (-(-folded // IMPACT_STEP)).astype(np.uint8).tobytes()


@dataclass
class Index:
    """Tables in the shared folder: ``rows`` (id, row, text, sketch) and ``terms`` (term, df, tf); and the totals."""

    rows: DataFrame
    terms: DataFrame
    documents: int
    n_terms: int
    paths: tuple[str, ...]

    def drop(self) -> None:
        """Delete the tables, after the last search."""
        drop(self.rows.sparkSession, *self.paths)


def count_terms(texts: DataFrame) -> DataFrame:
    """``term, df, tf``: in how many documents each term is, and how often. The term NULL stands for any term.

    Each task counts before it sends; a term of all documents costs a row for
    each task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        often: Counter = Counter()
        n = total = 0

        def sent() -> pa.RecordBatch:
            names = list(seen)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*names, None], pa.string()),
                    pa.array([*(seen[t] for t in names), n], pa.int64()),
                    pa.array([*(often[t] for t in names), total], pa.int64()),
                ],
                names=["term", "df", "tf"],
            )

        for batch in batches:
            for text in _utf8(batch.column(0)):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                n, total = n + 1, total + len(terms)
                often.update(terms)
                seen.update(set(terms))
                if len(seen) > SENT_TERMS:
                    yield sent()
                    n = total = 0
                    seen.clear()
                    often.clear()
        yield sent()

    found = texts.mapInArrow(count, "term string, df long, tf long")
    return found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Index:
    """Index every row of the documents.

    Texts are read twice: once to count terms, once to sketch and write them.
    Texts that are NULL or have no term match nothing and are not in the index.
    Rows with one id are documents of their own. A long text is one row, and
    its sketch has at most ``MOST_WIDTH`` bytes. Other columns are not kept.
    """
    terms, terms_path = written(count_terms(docs.select(text_column)), "terms")
    totals = terms.filter("term IS NULL").first()  # one row, from the groups of NULL
    documents, n_terms = (totals["df"], totals["tf"]) if totals else (0, 0)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            kept, made = [], []
            for i, text in enumerate(_utf8(batch.column("text"))):
                counts = Counter(terms_of(text.as_py()))
                if counts:
                    m = length_norm(counts.total(), documents, n_terms)
                    kept.append(i)
                    made.append(sketch(counts, m, hashes))
            rows = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(made, pa.binary())], names=["id", "row", "text", "sketch"])

    narrow = docs.select(
        F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_column).alias("text")
    )
    kind = narrow.schema["id"].dataType.simpleString()
    rows, rows_path = written(narrow.mapInArrow(sketched, f"id {kind}, row long, text string, sketch binary"), "index")
    return Index(rows, terms.filter("term IS NOT NULL"), documents, n_terms, (terms_path, rows_path))


@dataclass
class Block:
    """Items that are looked up together: their ids, the terms they hold with weights, and each item's terms."""

    items: list
    terms: list[bytes]
    weights: np.ndarray
    holds: list[np.ndarray]


def weight(documents: int) -> Column:
    """The weight of a term that ``df`` of all documents hold."""
    return F.floor(1000 * F.log((F.lit(2.0) * documents + 2) / (2 * F.col("df") + 1))).cast("long")


def blocks_of(index: Index, items: DataFrame, id_column: str, text_column: str) -> Iterator[Block]:
    """The items in blocks of bounded size, read one partition at a time.

    Terms that no document holds cannot score and are left out.
    """

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [sorted(set(terms_of(t.as_py()))) for t in _utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), pa.array(sets, pa.list_(pa.string()))], names=["item", "terms"]
            )

    narrow = items.select(F.col(id_column).alias("item"), F.col(text_column).alias("text"))
    kind = narrow.schema["item"].dataType.simpleString()
    sets = narrow.mapInArrow(distinct, f"item {kind}, terms array<string>").withColumn(
        "row", F.monotonically_increasing_id()
    )
    sets, path = written(sets, "items")
    exploded = sets.select("item", "row", F.explode("terms").alias("term"))
    known = exploded.join(index.terms, "term").select("item", "row", "term", weight(index.documents).alias("w"))
    grouped = known.groupBy("row", "item").agg(F.collect_list(F.struct("term", "w")).alias("found"))

    found, found_path = written(grouped, "queries")
    held: list = []
    size = 0
    # Queries, not documents, come to the driver: a block of them at a time.
    for row in found.toLocalIterator():
        held.append(row)
        size += len(row["found"])
        if size >= BLOCK_TERMS:
            yield _block(held)
            held, size = [], 0
    if held:
        yield _block(held)
    drop(index.rows.sparkSession, path, found_path)


def _block(rows: list) -> Block:
    weights = {t["term"].encode(): t["w"] for r in rows for t in r["found"]}
    place = {t: i for i, t in enumerate(weights)}
    holds = [np.array(sorted(place[t["term"].encode()] for t in r["found"]), dtype=np.int64) for r in rows]
    return Block([r["item"] for r in rows], list(weights), np.fromiter(weights.values(), np.int64, len(weights)), holds)


class Bounds:
    """Upper bounds of the scores of a block's items for many sketches."""

    def __init__(self, block: Block):
        joined = np.concatenate(block.holds)
        self.weights = block.weights[joined].astype(np.float64)
        self.codes = Hashes()(block.terms)[joined]
        self.begins = np.cumsum([0, *map(len, block.holds[:-1])])

    def __call__(self, sketches: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in the list, and the bounds of these by item; sketches of one width at a time."""
        widths = np.fromiter(map(len, sketches), dtype=np.int64, count=len(sketches))
        step = max(1, _LOOKED_UP // len(self.codes))
        for width in np.unique(widths):
            places = np.flatnonzero(widths == width)
            slots = self.codes & (width - 1)
            for at in range(0, len(places), step):
                some = places[at : at + step]
                table = np.frombuffer(b"".join(sketches[i] for i in some), dtype=np.uint8).reshape(-1, width)
                # Whole numbers far below 2 ** 53, so the sums are exact.
                yield some, np.add.reduceat(table[:, slots] * self.weights, self.begins, axis=1) * IMPACT_STEP


class Scorer:
    """Exact scores of one text for the items of a block."""

    def __init__(self, block: Block, documents: int, n_terms: int):
        self.place = {t: i for i, t in enumerate(block.terms)}
        self.block, self.documents, self.n_terms = block, documents, n_terms

    def gains(self, text: bytes) -> np.ndarray:
        """What each term of the block adds to the score of an item that holds it."""
        counts = Counter(terms_of(text))
        m = length_norm(counts.total(), self.documents, self.n_terms)
        known = [(self.place[t], c) for t, c in counts.items() if t in self.place]
        out = np.zeros(len(self.block.terms), dtype=np.int64)
        if known:
            where, tf = np.array(known, dtype=np.int64).T
            out[where] = self.block.weights[where] * impacts(tf, m)
        return out

    def score(self, gains: np.ndarray, item: int) -> int:
        return int(gains[self.block.holds[item]].sum())


def _top(df: DataFrame, by: str, order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group, with their ``rank``; first in parts of a group, then of these."""
    parts = df.withColumn("_part", F.spark_partition_id() % _PARTS)
    for keys in ((by, "_part"), (by,)):
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        parts = parts.withColumn("rank", number).filter(F.col("rank") <= limit)
    return parts.drop("_part")


def _first_scores(index: Index, block) -> DataFrame:
    """``j, score`` of the documents with the highest bounds of each item, scored exactly."""
    totals = (index.documents, index.n_terms)

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(block.value)
        n_items = len(block.value.items)
        best = np.zeros((0, n_items))
        rows = np.zeros((0, n_items), dtype=np.int64)
        for batch in batches:
            keys = batch.column("row").to_numpy(zero_copy_only=False)
            for places, found in bounds(batch.column("sketch").to_pylist()):
                best = np.concatenate([best, found])
                rows = np.concatenate([rows, np.broadcast_to(keys[places, None], found.shape)])
                if len(best) > FIRST_TRIES:
                    top = np.argpartition(-best, FIRST_TRIES - 1, axis=0)[:FIRST_TRIES]
                    best, rows = np.take_along_axis(best, top, 0), np.take_along_axis(rows, top, 0)
        if len(best):
            item = np.broadcast_to(np.arange(n_items), best.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item.ravel(), pa.int32()), pa.array(rows.ravel(), pa.int64()), pa.array(best.ravel(), pa.float64())],
                names=["j", "row", "bound"],
            )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(block.value, *totals)
        for batch in batches:
            items: list[int] = []
            scores: list[int] = []
            for text, js in zip(_utf8(batch.column("text")), batch.column("js").to_pylist(), strict=True):
                gains = scorer.gains(text.as_py())
                items += js
                scores += [scorer.score(gains, j) for j in js]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), pa.array(scores, pa.int64())], names=["j", "score"])

    tries = index.rows.select("row", "sketch").mapInArrow(highest, "j int, row long, bound double")
    chosen = _top(tries, "j", [F.desc("bound"), F.asc("row")], FIRST_TRIES)
    # At most FIRST_TRIES rows for each item of the block, whose size is bounded.
    by_row = F.broadcast(chosen.groupBy("row").agg(F.collect_list("j").alias("js")))
    return index.rows.select("row", "text").join(by_row, "row").select("text", "js").mapInArrow(scored, "j int, score long")


def _known_scores(index: Index, block, k: int) -> np.ndarray:
    """A score that the k-th best document of each item has at least; 1 if fewer are known."""
    first = _first_scores(index, block).filter("score > 0")
    known = np.ones(len(block.value.items), dtype=np.int64)
    # One row for each item of the block comes to the driver.
    for row in _top(first, "j", [F.desc("score")], k).filter(F.col("rank") == k).collect():
        known[row["j"]] = row["score"]
    return known


def _best(index: Index, block, known: np.ndarray, k: int, kind: str) -> DataFrame:
    """``j, doc_id, score`` of every document that may be among the k best of an item.

    Each task takes the documents of an item by descending bound and scores them
    until the bounds fall below what its k-th best is known to reach.
    """
    totals = (index.documents, index.n_terms)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, scorer, least = Bounds(block.value), Scorer(block.value, *totals), known.copy()
        best: list[list[int]] = [[] for _ in least]
        for batch in batches:
            rows: list[tuple[int, int, int]] = []
            texts = _utf8(batch.column("text"))
            for places, found in bounds(batch.column("sketch").to_pylist()):
                gains: dict[int, np.ndarray] = {}
                for j in np.flatnonzero(found.max(axis=0) >= least):
                    for i in np.argsort(-found[:, j], kind="stable"):
                        if found[i, j] < least[j]:
                            break
                        if i not in gains:
                            gains[i] = scorer.gains(texts[int(places[i])].as_py())
                        score = scorer.score(gains[i], j)
                        if score < least[j]:
                            continue
                        rows.append((j, places[i], score))
                        (heapq.heappush if len(best[j]) < k else heapq.heappushpop)(best[j], score)
                        if len(best[j]) == k:
                            least[j] = max(least[j], best[j][0])
            if rows:
                item, place, score = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.int32()), batch.column("id").take(pa.array(place, pa.int64())), pa.array(score, pa.int64())],
                    names=["j", "doc_id", "score"],
                )

    return index.rows.select("id", "text", "sketch").mapInArrow(scored, f"j int, doc_id {kind}, score long")


def search(
    index: Index, items: DataFrame, k: int = 10, id_column: str = "item_id", text_column: str = "text"
) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``.

    Only scores above 0 count; equal scores stand in ascending order of the
    document id, a NULL id first. Items without a term that a document holds
    have no row; items with one id are ranked each on its own. An empty index
    and no items give no row. Other columns of both tables are not read. The
    answer is exact: a bound is never below the score, and each document whose
    bound reaches the score known for the k-th best is scored.
    """
    spark = index.rows.sparkSession
    kind = index.rows.schema["id"].dataType.simpleString()
    item_kind = items.schema[id_column].dataType.simpleString()
    schema = f"item_id {item_kind}, rank int, doc_id {kind}, score long"
    path = new_path(spark, "ranked")
    spark.createDataFrame([], schema).write.parquet(path)
    for made in blocks_of(index, items, id_column, text_column):
        block = spark.sparkContext.broadcast(made)
        names = spark.createDataFrame(list(enumerate(made.items)), f"j int, item_id {item_kind}")
        best = _best(index, block, _known_scores(index, block, k), k, kind)
        ranked = _top(best, "j", [F.desc("score"), F.asc_nulls_first("doc_id")], k)
        named = ranked.join(F.broadcast(names), "j").select("item_id", "rank", "doc_id", "score")
        named.write.mode("append").parquet(path)
        block.destroy()
    return spark.read.schema(schema).parquet(path)
