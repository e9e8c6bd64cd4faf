"""Near-duplicate documents: MinHash bands for candidates, odd sketches to thin them, full sets to confirm."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headingflow.llm.components import components
from headingflow.llm.shingles import Sketcher, normal_words, sketched
from headingflow.llm.storage import drop, written

WIDTH = 5
#: Shared shingles in percent of all shingles of a pair.
PERCENT = 85
#: 20 bands of 5 samples miss a pair at 85 percent 8 times in a million.
BANDS, ROWS = 20, 5
#: Samples folded into an odd sketch, and its bits.
SAMPLES, BITS = 384, 1536
#: A candidate goes on to the full sets if its estimate lies above the
#: threshold less so many standard deviations of the estimate.
SIGMAS = 4.5


def _estimate_floor(percent: int, samples: int) -> float:
    share = percent / 100
    return max(0.0, share - SIGMAS * math.sqrt(share * (1 - share) / samples))


def most_odd_bits(percent: int, samples: int, bits: int = BITS) -> int:
    """The differing bits of two odd sketches up to which a pair is confirmed."""
    apart = 2 * samples * (1 - _estimate_floor(percent, samples))
    return math.ceil(bits / 2 * (1 - math.exp(-2 * apart / bits)))


def odd_bits(left: str, right: str, words: int = BITS // 64) -> Column:
    """Differing bits of the sketches of two aliased tables."""
    return sum(
        (F.bit_count(F.col(f"{left}.sketch")[i].bitwiseXOR(F.col(f"{right}.sketch")[i])) for i in range(words)),
        F.lit(0),
    )


def _sketches(df: DataFrame, id_column: str, text_column: str, sketcher: Sketcher, width: int) -> DataFrame:
    kind = df.schema[id_column].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for sizes, digests, full, keys, odd in sketched(batch.column("_text").to_pylist(), sketcher, width):
                place = np.full(len(sizes), -1)
                place[full] = np.arange(len(full))
                take = pa.array(place, pa.int64(), mask=place < 0)

                def lists(values: np.ndarray, take: pa.Array = take) -> pa.Array:
                    offsets = np.arange(len(values) + 1, dtype=np.int32) * (values.shape[1] if len(values) else 0)
                    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), pa.int64())).take(take)

                columns = [
                    batch.column("_id").slice(done, len(sizes)),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    lists(keys),
                    lists(odd),
                ]
                done += len(sizes)
                yield pa.RecordBatch.from_arrays(columns, names=["_id", "n_shingles", "digest", "keys", "sketch"])

    rows = df.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text"))
    return rows.mapInArrow(
        sketch, f"_id {kind}, n_shingles long, digest binary, keys array<long>, sketch array<long>"
    )


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole shingle sets share enough."""

    def shingle_set(text: str) -> set:
        words = normal_words(text)
        if len(words) < width:
            return {tuple(words)} if words else set()
        return set(zip(*(words[i:] for i in range(width)), strict=False))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come in order of b, so its set serves all its pairs.
        last, there = None, set()
        for batch in batches:
            linked = []
            columns = (batch.column(c).to_pylist() for c in ("_text_a", "_text_b"))
            for one, other in zip(*columns, strict=True):
                if other != last:
                    last, there = other, shingle_set(other)
                here = shingle_set(one)
                shared = len(here & there)
                linked.append(shared > 0 and 100 * shared >= percent * (len(here) + len(there) - shared))
            kept = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(kept) for c in ("a", "b")], names=["a", "b"])

    first = texts.select(F.col("_id").alias("a"), F.col("_text").alias("_text_a"))
    second = texts.select(F.col("_id").alias("b"), F.col("_text").alias("_text_b"))
    whole = pairs.join(first, "a").join(second, "b").select("a", "b", "_text_a", "_text_b")
    kinds = dict(pairs.dtypes)
    return whole.mapInArrow(check, f"a {kinds['a']}, b {kinds['b']}")


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``id_column, n_shingles, component_id, kept`` for every row.

    Documents are linked if their sets of ``width``-word shingles share at least
    ``percent`` of their union. ``component_id`` is the smallest id that links
    reach, ``kept`` marks the row that bears it.

    Equal word sequences are one class from the start, so copies are never
    paired. In each bucket of a band the classes are compared with one pivot,
    the class with the largest buckets. Only where classes in a bucket are not
    in one component after that, those outside its largest component are
    compared with the rest by their odd sketches inside the join. What passes
    is confirmed on the full sets. So a bucket of n copies of one text costs n
    comparisons, and no link between components is left out.

    An empty or NULL text, or one without words, has no shingles and stays
    alone. A NULL id is never linked and is kept with a NULL component. Rows
    that repeat an id are one document and share their decision. Other columns
    are neither read nor returned.
    """
    spark = df.sparkSession
    sketcher = Sketcher(bands, rows, SAMPLES, BITS)
    most = most_odd_bits(percent, sketcher.n_samples)
    sketches, sketches_path = written(_sketches(df, id_column, text_column, sketcher, width), "sketches")

    found = sketches.filter("digest is not null and _id is not null")
    one = found.groupBy("digest").agg(
        F.min("_id").alias("rep"),
        F.first("n_shingles").alias("size"),
        F.first("keys").alias("keys"),
        F.first("sketch").alias("sketch"),
    )
    classes, classes_path = written(one, "classes")
    buckets = classes.select("rep", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    crowded, crowded_path = written(buckets.join(shared, "key"), "buckets")
    weight = crowded.groupBy("rep").agg(F.sum("n").alias("weight"))
    pivots = (
        crowded.join(weight, "rep")
        .groupBy("key")
        .agg(F.max_by("rep", F.struct("weight", "rep")).alias("pivot"))
    )
    # All that can be compared: their sketches, and by one pass over the table their texts.
    members = crowded.select("rep").distinct()
    sketch_of = classes.join(members, "rep", "left_semi").groupBy("rep").agg(
        *[F.first(c).alias(c) for c in ("size", "sketch", "keys")]
    )
    sketch_of, sketch_path = written(sketch_of, "members")
    whole = df.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text"))
    wanted = members.select(F.col("rep").alias("_id")).hint("shuffle_hash")
    texts, texts_path = written(whole.join(wanted, "_id", "left_semi"), "texts")

    def alike(left: str, right: str) -> Column:
        """Whether two sketches, and two set sizes, allow a link."""
        small, large = (f(f"{left}.size", f"{right}.size") for f in (F.least, F.greatest))
        return (100 * small >= percent * large) & (odd_bits(left, right) <= most)

    def likely(pairs: DataFrame) -> DataFrame:
        x, y = sketch_of.alias("x"), sketch_of.alias("y")
        joined = pairs.join(x, F.col("a") == F.col("x.rep")).join(y, F.col("b") == F.col("y.rep"))
        return joined.filter(alike("x", "y")).select("a", "b")

    starred = crowded.join(pivots, "key").filter("rep <> pivot")
    first, first_path = written(likely(starred.select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()), "pairs")

    def linked(pairs: DataFrame) -> tuple[DataFrame, str]:
        return written(_confirm(pairs, texts, width, percent), "links")

    links, links_path = linked(first)
    labels, labels_path = components(links)

    # Buckets that still hold several components.
    named = crowded.join(labels, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", F.coalesce("label", "rep").alias("label")
    )
    parts = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max_by("label", F.struct("n", "label")).alias("main"))
    open_rows, open_path = written(
        named.join(mixed.filter("parts > 1"), "key").join(sketch_of, "rep").drop("parts"), "open"
    )
    outside, inside = open_rows.filter("label <> main").alias("x"), open_rows.alias("y")
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.label") != F.col("y.label"))
    # A pair that meets in several buckets is made in one of them.
    once = F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("x.key")
    more = (
        outside.join(inside, apart & alike("x", "y") & once)
        .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
        .distinct()
    )
    tested = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second, second_path = written(more.join(tested, ["a", "b"], "left_anti"), "pairs")
    if not second.isEmpty():
        late, late_path = linked(second)
        drop(spark, labels_path)
        labels, labels_path = components(links.unionByName(late))
        drop(spark, late_path)

    named_classes = classes.join(labels, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("label", "rep").alias("component_id")
    )
    named_classes, _ = written(named_classes, "components")
    drop(spark, classes_path, crowded_path, first_path, links_path, labels_path, open_path, second_path)
    drop(spark, sketch_path, texts_path)
    narrow = sketches.select("_id", "n_shingles", "digest").join(named_classes, "digest", "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("component_id", "_id"))
    return narrow.select(
        F.col("_id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"),
    )
