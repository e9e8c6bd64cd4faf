"""Word ids and fixed-length id sequences."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headingflow.operators.numbering import number_rows
from headingflow.sources.shared import discard, materialise

NUM_WORDS = 20000
MAX_LENGTH = 300
PAD_ID = 0
OOV_ID = 1
FIRST_WORD_ID = 2

# The characters that split words, besides the blank.
WORD_BREAKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"

# Words in a bucket of the lookup, on average.
_BUCKET_WORDS = 16


def words(text: Column) -> Column:
    """Lower-case words between breaks and blanks, as an array."""
    blanks = " " * len(WORD_BREAKS)
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAKS, blanks)
    return F.filter(F.split(plain, " "), lambda w: w != "")


def vocabulary(df: DataFrame, column: str, num_words: int = NUM_WORDS) -> DataFrame:
    """The most frequent words as ``word, word_id, n``; ids run from 2 to ``num_words`` - 1.

    Ties in frequency go by word. Counting combines on the map side, so a word
    that makes up most of the text costs one row per task. The words per
    frequency tell the frequency at which the ids end, and only words at or
    above it are put in order.
    """
    counted = (
        df.select(F.explode(words(F.col(column))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = materialise(counted, "word-counts")
    # One row per frequency: their number grows with the root of the tokens at most.
    frequencies = counted.groupBy("n").agg(F.count(F.lit(1)).alias("_words"))
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    reached = frequencies.withColumn("_above", F.coalesce(F.sum("_words").over(above), F.lit(0)))
    least = reached.filter(F.col("_above") < max(0, num_words - FIRST_WORD_ID)).agg(F.min("n")).first()[0]
    frequent = counted.filter(F.col("n") >= (least if least is not None else F.lit(None)))
    ranked = number_rows(frequent, [F.desc("n"), F.asc("word")], "word_id", start=FIRST_WORD_ID)
    kept = ranked.filter(F.col("word_id") < num_words)
    made = materialise(kept.select("word", F.col("word_id").cast("int").alias("word_id"), "n"), "vocabulary")
    discard(counted)
    return made


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def _lookup(vocab: DataFrame, buckets: int) -> Column:
    # The whole vocabulary, at most ``num_words`` entries, as one scalar: an
    # array of small maps, so that a lookup is one hash and a short scan.
    per_bucket = vocab.groupBy(_bucket(F.col("word"), buckets).alias("bucket")).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "word_id"))).alias("ids")
    )
    every = vocab.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    slots = F.sort_array(F.collect_list(F.struct("bucket", F.map_keys("ids").alias("w"), F.map_values("ids").alias("i"))))
    whole = every.join(per_bucket, "bucket", "left").agg(slots.alias("slots"))
    return whole.select(
        F.transform("slots", lambda s: F.map_from_arrays(s["w"], s["i"])).alias("lookup")
    ).scalar()


def encode_sequences(
    df: DataFrame,
    vocab: DataFrame,
    column: str,
    out: str = "word_ids",
    length: int = MAX_LENGTH,
    num_words: int = NUM_WORDS,
) -> DataFrame:
    """Ids of the first ``length`` words, padded at the end; other words get the out-of-vocabulary id.

    One projection: no row is exploded and nothing is shuffled. Of ``vocab`` the
    ids below ``num_words`` count, so what reaches every row is bounded by it.
    """
    buckets = max(1, num_words // _BUCKET_WORDS)
    vocab = vocab.filter(F.col("word_id") < num_words)
    ids = F.transform(
        F.slice(words(F.col(column)), 1, length),
        lambda w: F.coalesce(F.element_at(F.get("_lookup", _bucket(w, buckets)), w), F.lit(OOV_ID)),
    )
    padding = F.array_repeat(F.lit(PAD_ID), length)
    return (
        df.withColumn("_lookup", _lookup(vocab, buckets))
        .withColumn(out, F.slice(F.concat(ids, padding), 1, length))
        .drop("_lookup")
    )
