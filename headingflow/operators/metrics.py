"""Daily and overall quality of predictions, each from one aggregation."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headingflow.functions.candidates import OTHER, truth_rank
from headingflow.functions.text import quoted
from headingflow.functions.values import number, text_or_empty
from headingflow.operators.guards import report_ks

REPORT_KS = (1, 4, 10)
THRESHOLDS = (0.30, 0.40, 0.50, 0.60, 0.70)


def threshold_name(prefix: str, threshold: float) -> str:
    """``review_rate`` and 0.3 give ``review_rate_t030``: no dot, so that it needs no quotes."""
    return f"{prefix}_t{round(threshold * 100):03d}"


def sink_name(column: str) -> str:
    """The name in CSV files: ``review_rate_t030`` becomes ``review_rate_t0.30``."""
    head, mark, digits = column.rpartition("_t")
    return f"{head}_t{int(digits) / 100:.2f}" if mark and digits.isdigit() else column


def _flags(predictions: DataFrame, truth: str, ks: Sequence[int], keys: Sequence[str]) -> DataFrame:
    """Slim rows: the keys, the confidence, and whether top-1 and each top-k hit."""
    ranked = predictions.select(
        *keys,
        number(F.col("pred_confidence"), default=0.0).alias("conf"),
        (text_or_empty(F.col("pred_heading")) == text_or_empty(F.col(truth))).alias("hit_1"),
        *([truth_rank(F.col("candidates"), F.col(truth)).alias("truth_rank")] if max(ks) > 1 else []),
    )
    wider = [f"coalesce(truth_rank between 1 and {k}, false) as hit_{k}" for k in ks if k > 1]
    return ranked.selectExpr(*[quoted(k) for k in keys], "conf", "hit_1", *wider)


def _grouped(flags: DataFrame, keys: Sequence[str], totals: Sequence[str], shown: Sequence[str]) -> DataFrame:
    """One aggregation into ``totals``, then the ``shown`` expressions over them."""
    names = ", ".join(quoted(k) for k in keys)
    grouped = f"select {', '.join([*filter(None, [names]), *totals])} from {{flags}}"
    if keys:
        grouped += f" group by {names}"
    listed = ", ".join([*filter(None, [names]), *shown])
    return flags.sparkSession.sql(f"select {listed} from ({grouped})", flags=flags)


def daily_metrics(
    predictions: DataFrame,
    truth: str = "heading",
    ks: Sequence[int] = REPORT_KS,
    thresholds: Sequence[float] = THRESHOLDS,
    keys: Sequence[str] = ("date",),
    max_k: int | None = None,
) -> DataFrame:
    """Accuracy, coverage, error and rescue rates per day.

    Reads ``pred_heading``, ``pred_confidence``, ``candidates``, the truth and a
    ``date``; rows without a date drop out. Top-1 is exact equality; the wider
    tops compare trimmed candidates, and a blank truth misses. A rate over no
    rows is NULL. All ks and thresholds come from one aggregation with map-side
    combining, so a day with most of the rows is no hot spot.
    """
    ks = report_ks(ks, max_k or max(ks))
    top = ks[-1]
    wider = [k for k in ks if k > 1]
    flags = _flags(predictions.filter(F.col("date").isNotNull()), truth, ks, keys)

    totals = ["count(*) as n", "avg(conf) as avg_conf"]
    totals += [f"count_if(hit_{k}) as n_top{k}" for k in [1, *wider]]
    totals += [
        f"count_if(hit_{k} and not hit_{narrower}) as n_top{k}_only"
        for narrower, k in zip([1, *wider], wider)
    ]
    totals.append(f"count_if(not hit_{top}) as n_outside_top{top}")
    shown = ["n", "avg_conf"]
    shown += [f"try_divide(n_top{k}, n) as top{k}" for k in [1, *wider]]
    shown += [f"try_divide(n_outside_top{top}, n) as outside_top{top}", "n_top1"]
    for k in wider:
        shown += [f"n_top{k}", f"n_top{k}_only"]
    shown.append(f"n_outside_top{top}")
    for t in thresholds:
        auto, wrong = threshold_name("auto", t), threshold_name("wrong", t)
        totals.append(f"count_if(conf >= {float(t)}D) as {auto}")
        totals.append(f"count_if(conf >= {float(t)}D and not hit_1) as {wrong}")
        shown.append(f"try_divide(n - {auto}, n) as {threshold_name('review_rate', t)}")
        shown.append(f"try_divide({auto}, n) as {threshold_name('auto_coverage', t)}")
        shown.append(f"try_divide({wrong}, {auto}) as {threshold_name('auto_error_rate', t)}")
        for k in wider:
            rescued = threshold_name(f"rescued{k}", t)
            totals.append(f"count_if(conf >= {float(t)}D and not hit_1 and hit_{k}) as {rescued}")
            shown.append(f"try_divide({rescued}, {auto}) as {threshold_name(f'auto_top{k}_rescue', t)}")
    return _grouped(flags, keys, totals, shown)


def daily_top1(
    predictions: DataFrame, truth: str = "heading_eval", keys: Sequence[str] = ("date",)
) -> DataFrame:
    """Rows, mean confidence and top-1 accuracy per day."""
    flags = _flags(predictions.filter(F.col("date").isNotNull()), truth, [1], keys)
    totals = ["count(*) as n", "avg(conf) as avg_conf", "count_if(hit_1) as n_top1"]
    return _grouped(flags, keys, totals, ["n", "avg_conf", "try_divide(n_top1, n) as top1", "n_top1"])


def _rates(
    flags: DataFrame,
    keys: Sequence[str],
    ks: Sequence[int],
    name: str,
    extra: Sequence[str] = (),
    more_totals: Sequence[str] = (),
) -> DataFrame:
    totals = ["count(*) as n", *[f"count_if(hit_{k}) as n_top{k}" for k in ks], *more_totals]
    shown = ["n", *[f"try_divide(n_top{k}, n) as {name.format(k)}" for k in ks], *extra]
    return _grouped(flags, keys, totals, shown)


def headline(
    predictions: DataFrame,
    truth: str = "heading",
    ks: Sequence[int] = REPORT_KS,
    keys: Sequence[str] = (),
    collapsed: str | None = None,
    other: str = OTHER,
) -> DataFrame:
    """Top-k rates and the share outside the largest k, over all rows or per key.

    With ``collapsed``, a truth with rare headings collapsed, also the rows
    where it is ``other``, and their share.
    """
    ks = report_ks([1, *ks], max(ks))
    outside = f"try_divide(n - n_top{ks[-1]}, n) as outside_top{ks[-1]}"
    if collapsed is None:
        return _rates(_flags(predictions, truth, ks, keys), keys, ks, "top{}", [outside])
    marked = predictions.withColumn("_is_other", F.coalesce(F.col(collapsed) == other, F.lit(False)))
    flags = _flags(marked, truth, ks, [*keys, "_is_other"])
    extra = [outside, "n_other", "try_divide(n_other, n) as other_share"]
    return _rates(flags, keys, ks, "top{}", extra, ["count_if(_is_other) as n_other"])


def other_share(df: DataFrame, truth: str = "heading_eval", other: str = OTHER) -> DataFrame:
    """One row: rows whose truth is ``other``, and their share."""
    totals = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(truth) == other).alias("n_other"))
    return totals.selectExpr("n", "n_other", "try_divide(n_other, n) as other_share")


def validation_metrics(scored: DataFrame, truth: str = "heading", ks: Sequence[int] = (1, 3)) -> DataFrame:
    """One row: top-k accuracies of the scored validation rows."""
    ks = report_ks([1, *ks], max(ks))
    return _rates(_flags(scored, truth, ks, []), [], ks, "top{}_accuracy")


def text_length_stats(df: DataFrame, lengths: dict[str, Column]) -> DataFrame:
    """Mean, median and 95th percentile (interpolated) of each named word count.

    Lengths are counted per value first, so the exact percentiles see one row
    per distinct length and not one per text.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("length")) for k, c in lengths.items()])
    per_length = (
        df.select(F.explode(pairs).alias("p"))
        .groupBy("p.kind", "p.length")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    points = F.percentile("length", [0.5, 0.95], F.col("n"))
    return (
        per_length.groupBy("kind")
        .agg(
            (F.sum(F.col("length") * F.col("n")) / F.sum("n")).alias("mean"),
            points.alias("points"),
        )
        .select("kind", "mean", F.col("points")[0].alias("median"), F.col("points")[1].alias("p95"))
    )
