"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded texts.

The lexicon is learned from labelled documents: words, and beginnings of words,
that occur far more often in toxic ones. Texts are folded first, so that letters
of other scripts and digits put in for letters do not hide a word, and each
match counts by its weight, over the length of the text, unless it lies inside
an exception phrase.
"""

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headingflow.llm.labelled import LABELLED_ROWS, labelled_sample
from headingflow.llm.storage import drop, written

#: Entries of the lexicon, at most: those with the largest weights.
ENTRIES = 20_000
#: Toxic documents that an entry must occur in.
LEAST_DOCUMENTS = 5
#: How many times as likely in a toxic document an entry is, at least, and that less 1.5 standard errors.
#: The first round takes clear entries only; the next look at toxic documents that have none of those.
LEAST_RATIO = 8.0
SAFE_RATIOS = (30.0, 4.0, 4.0)
#: Lengths of the beginnings of words that are entries beside whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Folded phrases in which a word of the lexicon is harmless.
EXCEPTIONS = ("trash bag", "trash bin", "trash can", "clown fish", "circus clown", "pond scum")
#: Scores from here on are called toxic.
THRESHOLD = 0.3

# Letters of other scripts that look like Latin ones, and digits and signs read as letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ɑ": "a", "ɡ": "g", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
#: Characters that are written into words and not seen.
INVISIBLE = "­​‌‍⁠﻿"

_WORD = re.compile(r"[^\W_]+")
_MARKED = re.compile(r"[^\W\d_][0-9@$!]+(?=[^\W\d_])|(?<![0-9])[0-9@$!]+(?=[^\W\d_])")
_SPELLED = re.compile(r"(?<![^\W_])[^\W\d_](?:[.\-_*][^\W\d_])+(?![^\W_])")


def _letter_table() -> dict[int, str | None]:
    """One character of folded text for each that is not its own."""
    table: dict[int, str | None] = {ord(c): None for c in INVISIBLE}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)):
        plain = unicodedata.normalize("NFKD", chr(code))
        base = "".join(c for c in plain if not unicodedata.combining(c)).lower()
        if base != chr(code):
            table[code] = base
    for code in range(0x300, 0x370):
        table[code] = None
    for foreign, latin in HOMOGLYPHS.items():
        table[ord(foreign)] = latin
        table[ord(foreign.upper())] = latin if len(foreign.upper()) == 1 else table.get(ord(foreign.upper()[0]))
    return {k: v for k, v in table.items() if v is None or len(chr(k)) == 1}


@lru_cache(maxsize=1)
def _tables() -> tuple[dict[int, str | None], dict[int, str]]:
    return _letter_table(), str.maketrans(DIGITS)


def fold(text: str) -> str:
    """Lower case without accents; homoglyphs, digits inside words and letters spelled apart as plain words."""
    letters, digits = _tables()
    folded = text.lower()
    if not folded.isascii():
        folded = folded.translate(letters)
    if _MARKED.search(folded):
        folded = _MARKED.sub(lambda m: m[0].translate(digits), folded)
    return _SPELLED.sub(lambda m: re.sub(r"[.\-_*]", "", m[0]), folded)


def terms_of(text: str) -> set[str]:
    """Words of a folded text, and their beginnings with a star."""
    words = set(_WORD.findall(fold(text)))
    return words | {f"{w[:n]}*" for w in words for n in BEGINNINGS if len(w) > n}


@dataclass(frozen=True)
class Lexicon:
    """Weights of words (``word``) and of beginnings of words (``begi*``), and what turns their sum into a score.

    A match inside one of the ``exceptions``, folded phrases, does not count. The
    score is the logistic function of ``base + slope * density``; ``density`` is
    the sum of the weights over the logarithm of the number of words.
    """

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    base: float = -3.0
    slope: float = 1.0


class Matcher:
    """The Aho-Corasick automaton of a lexicon."""

    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.weights.items():
            bare, open_end = (term[:-1], True) if term.endswith("*") else (term, False)
            # A word starts after a character that is no letter or digit.
            held = self.automaton.get(bare, [])
            self.automaton.add_word(bare, [*held, (len(bare), weight, open_end)])
        for phrase in lexicon.exceptions:
            held = self.automaton.get(phrase, [])
            self.automaton.add_word(phrase, [*held, (len(phrase), 0.0, False)])
        if len(self.automaton):
            self.automaton.make_automaton()

    def density(self, text: str) -> float:
        """Sum of the weights, one for each word matched, the largest; over the length."""
        if not len(self.automaton) or not text:
            return 0.0
        folded = fold(text)
        best: dict[int, float] = {}
        exempt: list[tuple[int, int]] = []
        size = len(folded)
        for end, held in self.automaton.iter(folded):
            for length, weight, open_end in held:
                start = end - length + 1
                if start and folded[start - 1].isalnum():
                    continue
                if not open_end and end + 1 < size and folded[end + 1].isalnum():
                    continue
                if weight:
                    if weight > best.get(start, 0.0):
                        best[start] = weight
                else:
                    exempt.append((start, end))
        if not best:
            return 0.0
        total = sum(w for at, w in best.items() if not any(s <= at <= e for s, e in exempt))
        return total / math.log2(4 + folded.count(" ") + folded.count("\n"))

    def score(self, text: str) -> float:
        raised = self.lexicon.base + self.lexicon.slope * self.density(text)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, raised))))


def learn_lexicon(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    exceptions: tuple[str, ...] = EXCEPTIONS,
    most_rows: int = LABELLED_ROWS,
    entries: int = ENTRIES,
) -> Lexicon:
    """Weigh words by their documents of either label, and fit base and slope of the score.

    Of each label ``most_rows`` rows are used at most. Weights of words compare
    shares within either label, which a sample of each keeps; base and slope are
    fitted on rows weighted to the shares of all labels. Counting is a grouped
    aggregation; at most ``entries`` rows come to the driver. NULL labels are
    left out. Without toxic rows, or without others, the lexicon is empty and
    every score the share of toxic rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    sample = labelled_sample(texts, labels, label_column, id_column, most_rows)
    rows, path = written(sample.select("_text", F.col("_label").alias("_toxic"), "_weight"), "labelled")
    counted = rows.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("_weight").alias("whole")).collect()
    totals, whole = ({r["_toxic"]: r[c] for r in counted} for c in ("n", "whole"))
    n_bad, n_good = totals.get(1, 0), totals.get(0, 0)
    usual = math.log((whole.get(1, 0) + 0.5) / (whole.get(0, 0) + 0.5)) if n_bad + n_good else -50.0
    if not (n_bad and n_good):
        drop(spark, path)
        return Lexicon({}, exceptions, usual)

    good, good_path = written(_documents_of(rows.filter("_toxic = 0"), Lexicon({}), "good"), "terms")
    weights: dict[str, float] = {}
    for safe in SAFE_RATIOS:
        bad, bad_path = written(_documents_of(rows.filter("_toxic = 1"), Lexicon(weights, exceptions), "bad"), "terms")
        weights = _entries(bad, good, n_good, safe, entries) | weights
        drop(spark, bad_path)
    drop(spark, good_path)
    # An entry is not needed if a beginning of it weighs as much.
    weights = {
        t: w
        for t, w in weights.items()
        if not any(weights.get(f"{t.rstrip('*')[:n]}*", 0.0) >= w for n in BEGINNINGS if n < len(t.rstrip("*")))
    }
    # What a row of either label counts, 1 on average.
    mean = sum(whole.values()) / (n_bad + n_good)
    counts = {y: whole[y] / totals[y] / mean for y in totals}
    base, slope = _fit(rows, Lexicon(weights, exceptions), usual, counts)
    drop(spark, path)
    return Lexicon(weights, exceptions, base, slope)


def _documents_of(rows: DataFrame, lexicon: Lexicon, out: str) -> DataFrame:
    """``term, out``: documents of each term, those with a match of the lexicon left out; ``""`` is in all."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            tally: Counter[str] = Counter()
            for text in batch.column("_text"):
                whole = text.as_py()
                if not matcher.density(whole):
                    tally.update(terms_of(whole))
                    tally[""] += 1
            columns = [pa.array(list(tally), pa.string()), pa.array(list(tally.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "n"])

    return rows.mapInArrow(split, "term string, n long").groupBy("term").agg(F.sum("n").alias(out))


def _entries(bad: DataFrame, good: DataFrame, n_good: int, safe: float, most: int) -> dict[str, float]:
    """Terms that tell toxic documents without a match so far from documents that are not toxic.

    Words that merely stand beside toxic words gain nothing: their documents are
    explained already.
    """
    left = bad.filter("term = ''").first()
    if left is None:
        return {}
    often = bad.filter((F.col("bad") >= LEAST_DOCUMENTS) & (F.col("term") != ""))
    counted = often.join(good, "term", "left").withColumn("good", F.coalesce("good", F.lit(0)))
    ratio = ((F.col("bad") + 0.5) / (left["bad"] + 1)) / ((F.col("good") + 0.5) / (n_good + 1))
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    chosen = (
        counted.withColumn("weight", F.log(ratio))
        .filter(F.col("weight") >= math.log(LEAST_RATIO))
        .filter(F.col("weight") - 1.5 * error >= math.log(safe))
        .orderBy(F.desc(F.col("weight") * F.sqrt("bad")), "term")
        .limit(most)
        .collect()
    )
    return {r["term"]: float(r["weight"]) for r in chosen}


def _fit(rows: DataFrame, lexicon: Lexicon, usual: float, counts: dict[int, float]) -> tuple[float, float]:
    """Base and slope by logistic regression over a histogram of the densities: 200 classes, however many rows.

    A row counts as its label's entry of ``counts``.
    """
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def densities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            found = [min(199, round(10 * matcher.density(t))) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), batch.column("_toxic")], names=["d", "y"])

    table = rows.mapInArrow(densities, "d int, y int").groupBy("d", "y").count().collect()
    points = [(r["d"] / 10, r["y"], r["count"] * counts[r["y"]]) for r in table]
    base, slope = usual, 1.0
    for _ in range(200):  # Newton's steps, with a small pull of the slope towards 1
        g0 = g1 = h00 = h01 = h11 = 0.0
        for x, y, n in points:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, base + slope * x))))
            g0 += n * (y - p)
            g1 += n * (y - p) * x
            h00 += n * p * (1 - p)
            h01 += n * p * (1 - p) * x
            h11 += n * p * (1 - p) * x * x
        g1 -= slope - 1.0
        h00, h11 = h00 + 1e-3, h11 + 1.0
        det = h00 * h11 - h01 * h01
        steps = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        if max(map(abs, steps)) < 1e-9:
            break
        base, slope = (v + max(-1.0, min(1.0, s)) for v, s in zip((base, slope), steps, strict=True))
    return base, slope


def score_toxicity(
    df: DataFrame, lexicon: Lexicon, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id_column, score`` for every row, from 0 to 1.

    A NULL or empty text has the score of a text without a match. NULL ids and
    repeated rows give a row each. Other columns are neither read nor returned.
    The lexicon, of a bounded number of entries, is sent to the executors.
    """
    shared = df.sparkSession.sparkContext.broadcast(lexicon)
    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            found = [matcher.score(t.as_py()) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(found, pa.float64())], names=["_id", "score"])

    return rows.mapInArrow(score, f"_id {kind}, score double").withColumnRenamed("_id", id_column)
