"""Quality rules as weak supervision: rules vote or abstain, and their accuracies are estimated from the votes."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headingflow.llm.storage import drop, written

#: White space between words.
SPACES = " \t\n\x0b\f\r"
_SPACE_PATTERN = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50
ITERATIONS = 20
#: The steps end when no share changes by more.
TOLERANCE = 1e-5
#: Share of good documents before the first step.
PRIOR = 0.8
#: How often a rule votes good, votes bad and abstains before the first step, by class.
START = {"good": (0.60, 0.05, 0.35), "bad": (0.30, 0.30, 0.40)}
#: Votes that every rule is given beside its own, so that no estimate is 0 or 1.
SMOOTHING = 2.0
LEAST_POSTERIOR = 0.5


@dataclass(frozen=True)
class Rule:
    """Votes good (1) or bad (0), or abstains (NULL). Both are SQL over the statistics."""

    name: str
    good: str = "false"
    bad: str = "false"

    def vote(self) -> Column:
        return F.expr(f"case when {self.bad} then 0 when {self.good} then 1 end").cast("int")


def _within(symbols: float, repeats: float, lines: float, capitals: float, marks: float) -> str:
    """No defect above its share. A rule that looked at one defect alone would call all other junk good."""
    return (
        f"n_symbols <= {symbols} * n_words and n_repeat_words <= {repeats} * n_words and n_dup_lines <= {lines} * n_lines"
        f" and n_capitals <= {capitals} * word_chars and n_marks <= {marks} * n_words"
    )


#: A defect speaks against a document; that it lacks one defect says little for it.
RULES = (
    Rule("symbols", bad="n_symbols > 0.10 * n_words"),
    Rule("repeats", bad="n_repeat_words > 0.40 * n_words"),
    Rule("lines", bad="n_dup_lines > 0.50 * n_lines"),
    Rule("capitals", bad="n_capitals > 0.30 * word_chars"),
    Rule("marks", bad="n_marks > 0.20 * n_words"),
    Rule("clean", _within(symbols=0.01, repeats=0.10, lines=0.05, capitals=0.15, marks=0.05)),
    Rule("tolerable", _within(symbols=0.05, repeats=0.35, lines=0.45, capitals=0.25, marks=0.10)),
    Rule(
        "sentences",
        "n_stops > 0 and n_words between 2 * n_stops and 60 * n_stops and "
        + _within(symbols=0.03, repeats=0.35, lines=0.45, capitals=0.20, marks=0.08),
        "n_words > 400 * (n_stops + 1)",
    ),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for the row."""
    return F.transform(F.array(value), body)[0]


def _repeated_positions(words: Column, hashes: Column) -> Column:
    """Number of words in windows of three that occur twice or more.

    The hashes of the windows are sorted with their places, so equal ones are
    neighbours; what counts is whether the words at both places are equal.
    """
    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i")))

    def starts(ordered: Column) -> Column:
        def same(one: Column, other: Column) -> Column:
            a, b = one["i"], other["i"]
            equal = (words[a] == words[b]) & (words[a + 1] == words[b + 1]) & (words[a + 2] == words[b + 2])
            return F.coalesce((one["h"] == other["h"]) & equal, F.lit(False))

        twins = F.filter(
            ordered,
            lambda x, k: same(x, F.get(ordered, k - 1)) | same(x, F.get(ordered, k + 1)),
        )
        return F.transform(twins, lambda x: x["i"])

    def covered(first: Column) -> Column:
        # A second parameter would be the place in the array.
        second, third = F.transform(first, lambda i: i + 1), F.transform(first, lambda i: i + 2)
        return F.size(F.array_union(F.array_union(first, second), third))

    return _let(F.array_sort(placed), lambda ordered: _let(starts(ordered), covered))


def text_statistics(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id`` and the statistics that rules are made of, from one pass over whole texts.

    ``n_repeat_words`` counts the words that lie in a window of three words found
    twice or more in the text. Windows are hashed first; only a text with two
    equal hashes has the words of such windows compared.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = df.select(F.col(id_column).alias("_id"), text.alias("_text"))
    trimmed = F.trim("_text", F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{_SPACE_PATTERN}+"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0)
    rows = rows.select("_id", "_text", words.alias("_words"), lines.alias("_lines"))
    w = F.col("_words")
    hashes = F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])),
    )

    def found(characters: str) -> Column:
        """Occurrences of single-byte characters, from the bytes that are left without each."""
        gone = [F.octet_length("_text") - F.octet_length(F.replace("_text", F.lit(c), F.lit(""))) for c in characters]
        return sum(gone, F.lit(0))

    rows = rows.withColumn("_hashes", hashes)
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    counts = {
        "n_words": F.size(w),
        "word_chars": F.length("_text") - found(SPACES),
        "n_symbols": found(SYMBOLS),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.when(repeats, _repeated_positions(w, F.col("_hashes"))).otherwise(0),
        "n_distinct_words": F.size(F.array_distinct(w)),
        "n_capitals": F.length("_text") - F.length(F.regexp_replace("_text", r"\p{Lu}+", "")),
        "n_marks": found("!?"),
        "n_stops": found("."),
    }
    return rows.select("_id", *[c.cast("long").alias(name) for name, c in counts.items()])


Model = tuple[float, dict[str, dict[str, tuple[float, float, float]]]]


def _posterior(rules: tuple[Rule, ...], model: Model) -> Column:
    """Probability of a good document, given what each rule did."""
    prior, shares = model

    def likelihood(share: float, kind: str) -> Column:
        product = F.lit(share)
        for r in rules:
            yes, no, none = shares[kind][r.name]
            product = product * F.when(F.col(r.name) == 1, yes).when(F.col(r.name) == 0, no).otherwise(none)
        return product

    here, there = likelihood(prior, "good"), likelihood(1 - prior, "bad")
    return here / (here + there)


def fit_rules(votes: DataFrame, rules: tuple[Rule, ...] = RULES, iterations: int = ITERATIONS) -> Model:
    """Share of good documents; by class and rule, how often it votes good, votes bad and abstains.

    Expectation-maximisation over the distinct patterns of votes with their
    numbers of rows: three to the power of the number of rules at most, whatever
    the size of the table. A step reads them and gives one row of sums. Without
    rows the start values come back.
    """
    names = [r.name for r in rules]
    patterns, path = written(votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "votes")
    prior, shares = PRIOR, {kind: dict.fromkeys(names, start) for kind, start in START.items()}
    for _ in range(iterations):
        weighed = patterns.withColumn("_p", _posterior(rules, (prior, shares)))
        rows = {"good": F.col("n") * F.col("_p"), "bad": F.col("n") * (1 - F.col("_p"))}
        sums = [F.sum(n).alias(kind) for kind, n in rows.items()]
        for name in names:
            for kind, n in rows.items():
                sums += [F.sum(F.when(F.col(name) == v, n)).alias(f"{name}_{kind}_{v}") for v in (1, 0)]
        found = weighed.agg(*sums).first()
        if found["good"] is None:
            break
        total = found["good"] + found["bad"]
        prior = (found["good"] + SMOOTHING * PRIOR) / (total + SMOOTHING)
        before, shares = shares, {kind: {} for kind in START}
        for kind, start in START.items():
            for name in names:
                voted = [found[f"{name}_{kind}_{v}"] or 0.0 for v in (1, 0)]
                outcomes = (*voted, max(0.0, found[kind] - sum(voted)))
                shares[kind][name] = tuple(
                    (n + SMOOTHING * s) / (found[kind] + SMOOTHING) for n, s in zip(outcomes, start, strict=True)
                )
        changes = (
            abs(x - y)
            for kind in START
            for name in names
            for x, y in zip(shares[kind][name], before[kind][name], strict=True)
        )
        if max(changes, default=0.0) <= TOLERANCE:
            break
    drop(votes.sparkSession, path)
    return prior, shares


def accuracies(model: Model) -> dict[str, float]:
    """How often each rule is right when it votes."""
    prior, shares = model
    found = {}
    for name, (yes, no, _) in shares["good"].items():
        wrong_yes, right_no, _ = shares["bad"][name]
        right = prior * yes + (1 - prior) * right_no
        found[name] = right / (right + prior * no + (1 - prior) * wrong_yes)
    return found


def judge_quality(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``id_column``, the statistics, ``base_failed, quality, kept`` for every row.

    A document fails the base if it has fewer than 50 words, or if more than half
    of its words repeat. The rules vote on every document, the accuracy of each
    is estimated from how the votes of all agree, and ``quality`` is the
    posterior probability of a good document. ``kept`` is false where the base
    fails or the probability is below one half.

    A NULL text counts as empty and fails the base. NULL ids and repeated rows
    give a row each. Other columns are neither read nor returned. The statistics
    are written once to the shared folder, so that all steps see the same ones.
    """
    counted, _ = written(text_statistics(df, id_column, text_column), "statistics")
    votes = counted.select("*", *[r.vote().alias(r.name) for r in rules])
    model = fit_rules(votes, rules)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    judged = votes.withColumns({"quality": _posterior(rules, model), "base_failed": failed})
    return judged.select(
        F.col("_id").alias(id_column),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("quality") >= LEAST_POSTERIOR)).alias("kept"),
        F.round("quality", 6).alias("quality"),
    )
