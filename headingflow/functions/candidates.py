"""Ranked candidates in one array per row: ``array<struct<rank, heading, conf>>``.

Keeping the classes of a row in its own array means that ranking, decoding and
hit tests never shuffle.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from headingflow.functions.text import strip

OTHER = "Other"


def softmax(logits: Column) -> Column:
    """Probabilities of an array of logits, shifted by the maximum."""
    top = F.array_max(logits)
    powers = F.transform(logits, lambda x: F.exp(x - top))
    return F.aggregate(
        F.array(powers),
        F.lit(None).cast("array<double>"),
        lambda _, p: F.transform(
            p, lambda x: x / F.aggregate(p, F.lit(0.0), lambda total, y: total + y)
        ),
    )


def rank_classes(scores: Column, k: int | None = None, masked: Column | None = None) -> Column:
    """Classes by falling score, ties by class id, as ``struct<rank, class_id, conf>``.

    With fewer than ``k`` classes the result has fewer entries; ``k=None`` ranks
    all. For the best ``k`` the classes are walked once with the ``k`` best so
    far in hand, so only what enters these is sorted. Classes at whose place
    ``masked`` is true are left out.
    """
    keyed = F.transform(
        scores, lambda s, i: F.struct((-s).alias("minus"), i.cast("int").alias("class_id"))
    )
    if masked is not None:
        keyed = F.filter(keyed, lambda c: ~F.coalesce(F.get(masked, c["class_id"]), F.lit(False)))
    if k is None:
        ordered = F.sort_array(keyed)
    elif k == 1:
        ordered = F.filter(F.array(F.array_min(keyed)), lambda c: c.isNotNull())
    else:
        ordered = F.aggregate(
            keyed,
            F.expr("cast(array() as array<struct<minus:double,class_id:int>>)"),
            lambda held, c: F.when(F.get(held, F.lit(k - 1)) < c, held).otherwise(
                F.slice(F.sort_array(F.array_append(held, c)), 1, k)
            ),
        )
    return F.transform(
        ordered,
        lambda c, i: F.struct(
            (i + 1).cast("int").alias("rank"), c["class_id"].alias("class_id"), (-c["minus"]).alias("conf")
        ),
    )


def decode_classes(ranked: Column, headings: Column, unknown: str = "{}") -> Column:
    """Replace class ids by headings, ``headings`` being the array in class order.

    An unknown id is written into the ``unknown`` template.
    """
    return F.transform(
        ranked,
        lambda c: F.struct(
            c["rank"].alias("rank"),
            F.coalesce(F.get(headings, c["class_id"]), unknown_heading(c["class_id"], unknown)).alias(
                "heading"
            ),
            c["conf"].alias("conf"),
        ),
    )


def unknown_heading(class_id: Column, template: str = "{}") -> Column:
    before, after = template.split("{}")
    return F.concat(F.lit(before), class_id.cast("string"), F.lit(after))


def best(candidates: Column) -> Column:
    """The first candidate, NULL for an empty array."""
    return F.get(candidates, F.lit(0))


def best_except_other(ranked: Column, other: str = OTHER) -> Column:
    """The best candidate that is not ``other``, with its own score.

    For a ranking of all classes, since ``other`` may hide the next class beyond
    any k; scores of all classes are better masked when they are ranked. Where
    the ranking holds nothing else, its first candidate stays.
    """
    return F.coalesce(best(F.filter(ranked, lambda c: c["heading"] != other)), best(ranked))


def truth_rank(candidates: Column, truth: Column) -> Column:
    """First rank whose trimmed heading equals the trimmed truth; 0 when absent, NULL for a blank truth."""
    wanted = strip(truth)
    names = F.transform(candidates, lambda c: strip(c["heading"]))
    return F.array_position(names, F.when(wanted != "", wanted))


def hit_within(rank: Column, k: int) -> Column:
    return F.coalesce(rank.between(1, k), F.lit(False))


def reported_hit(truth: Column, predicted: Column, candidates: Column, alternates: int = 5) -> Column:
    """Hit test of the hold-out report: no trim, the prediction or one of the alternates."""
    wanted = F.when(truth != "", truth)
    names = F.concat(
        F.array(predicted), F.transform(F.slice(candidates, 1, alternates), lambda c: c["heading"])
    )
    return F.coalesce(F.exists(names, lambda h: h == wanted), F.lit(False))


def needs_review(confidence: Column, threshold: float = 0.25) -> Column:
    return confidence < F.lit(threshold)
