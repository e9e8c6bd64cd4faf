"""Quality by co-training: a view of the text and a view of the page teach each other.

Both classifiers are logistic regressions over a few numbers of each document.
They are fitted on a bounded sample of labelled rows and on all rows without a
label; every document is scored.
"""

import math
import operator
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headingflow.llm.labelled import LABELLED_ROWS, labelled_sample
from headingflow.llm.storage import drop, written

ROUNDS = 4
#: A view hands on what it is this sure of.
SURE = 0.95
#: Weight of a pseudo-label beside a label.
PSEUDO_WEIGHT = 0.5
#: Every so many labelled rows are left out of the fits, to calibrate and combine the views.
CALIBRATION = 5
THRESHOLD = 0.5
SYMBOLS = "#*$%&|<>"
SOURCE_SLOTS, LANG_SLOTS = 32, 8


def content_numbers(text: str) -> list[float]:
    """The view of the text: its words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * 10
    capital = sum(map(str.isupper, words))
    twice = sum(map(operator.eq, words, words[1:]))
    third = sum(map(operator.eq, words, words[2:]))
    shares = (
        len(set(words)) / n,
        capital / n,
        twice / n,
        third / n,
        min(1.0, sum(map(text.count, SYMBOLS)) / n),
        min(1.0, text.count("!") / n),
        min(1.0, text.count(".") / n),
        min(1.0, sum(map(text.count, "0123456789")) / n),
    )
    return [math.log1p(n), sum(map(len, words)) / n, *map(math.sqrt, shares)]


def page_numbers(text: str, lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """The view of the page: where it is from, its language, size and layout."""
    size = len(text) if n_chars is None else max(0, n_chars)
    lines = text.split("\n")
    filled = [x for x in lines if x]
    letters = sum(map(text.count, " \n\t")) / max(1, len(text))
    numbers = [
        math.log1p(size),
        math.log1p(len(lines)),
        math.log1p(max(map(len, lines))),
        len(set(filled)) / max(1, len(filled)),
        len(text.encode("utf-8", "surrogatepass")) / max(1, len(text)),
        letters,
        sum(x.endswith((".", "?", '"')) for x in filled) / max(1, len(filled)),
    ]
    slots = [0.0] * (SOURCE_SLOTS + LANG_SLOTS)
    if source is not None:
        slots[zlib.crc32(source.encode()) % SOURCE_SLOTS] = 1.0
    if lang is not None:
        slots[SOURCE_SLOTS + zlib.crc32(lang.encode()) % LANG_SLOTS] = 1.0
    return numbers + slots


@dataclass(frozen=True)
class View:
    """A logistic regression over numbers brought to mean 0 and deviation 1."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        standard = np.clip((x - self.mean) / self.scale, -8.0, 8.0)
        return np.clip(standard @ self.weights[:-1] + self.weights[-1], -30.0, 30.0)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30.0, 30.0)))


def _slopes(x: np.ndarray, y: np.ndarray, w: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Gradient and Hessian of the log-likelihood, in one line, as sums over the rows; the constant is last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    p = _sigmoid(x @ beta)
    hessian = (x * (w * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x
    return np.concatenate([x.T @ (w * (y - p)), hessian.ravel()])


def _step(slopes: np.ndarray, beta: np.ndarray, pull: float) -> np.ndarray:
    """Newton's step with a ridge."""
    n = len(beta)
    ridge = np.full(n, pull)
    ridge[-1] = 1e-6
    return np.linalg.solve(slopes[n:].reshape(n, n) + np.diag(ridge), slopes[:n] - ridge * beta)


def _regression(x: np.ndarray, y: np.ndarray, w: np.ndarray, pull: float) -> np.ndarray:
    """Weights and a constant last, by Newton's steps with a ridge."""
    beta = np.zeros(x.shape[1] + 1)
    for _ in range(50):
        step = _step(_slopes(x, y, w, beta), beta, pull)
        beta += np.clip(step, -3.0, 3.0)
        if np.abs(step).max() < 1e-8:
            break
    return beta


Views = tuple[View, View]
#: Sums, of the given number, that a function of both views' numbers makes of the rows without a label.
Over = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray], int], np.ndarray]


def _taught(past: list[Views], side: int, pool: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Pseudo-labels for a view, by the first round in which the other was sure; NaN where it never was."""
    found = np.full(len(pool[side]), np.nan)
    for views in past:
        chance = _sigmoid(views[1 - side].logits(pool[1 - side]))
        new = np.isnan(found)
        found[new & (chance >= SURE)] = 1.0
        found[new & (1 - chance >= SURE)] = 0.0
    return found


def fit_views(
    labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, w: np.ndarray, over: Over, past: list[Views]
) -> Views:
    """Both views, fitted on the labelled rows and on all that the ``past`` views hand over.

    Rows without a label come in as sums: one pass for mean and deviation, one
    for each of Newton's steps.
    """
    middle = [x.mean(axis=0) for x in labelled]
    sizes = [x.shape[1] for x in labelled]

    def moments(*pool: np.ndarray) -> np.ndarray:
        parts = []
        for side in (0, 1):
            x = pool[side][~np.isnan(_taught(past, side, pool))] - middle[side]
            parts += [[len(x)], x.sum(axis=0), (x**2).sum(axis=0)]
        return PSEUDO_WEIGHT * np.concatenate(parts)

    total = sum(2 * n + 1 for n in sizes)
    sums = over(moments, total) if past else np.zeros(total)
    scales = []
    for x, m, n, part in zip(labelled, middle, sizes, np.split(sums, [2 * sizes[0] + 1]), strict=True):
        count = w.sum() + part[0]
        shift = (w @ (x - m) + part[1 : n + 1]) / count
        scale = np.sqrt(np.maximum((w @ (x - m) ** 2 + part[n + 1 :]) / count - shift**2, 0.0))
        scale[scale < 1e-9] = 1.0
        scales.append((m + shift, scale))

    def standard(x: np.ndarray, side: int) -> np.ndarray:
        return np.clip((x - scales[side][0]) / scales[side][1], -8.0, 8.0)

    betas = [np.zeros(n + 1) for n in sizes]
    lengths = [(n + 1) * (n + 2) for n in sizes]
    own = [standard(x, side) for side, x in enumerate(labelled)]
    for _ in range(50):

        def slopes(*pool: np.ndarray, betas: list[np.ndarray] = betas) -> np.ndarray:
            parts = []
            for side in (0, 1):
                label = _taught(past, side, pool)
                x, known = standard(pool[side][~np.isnan(label)], side), label[~np.isnan(label)]
                parts.append(_slopes(x, known, np.full(len(x), PSEUDO_WEIGHT), betas[side]))
            return np.concatenate(parts)

        sums = over(slopes, sum(lengths)) if past else np.zeros(sum(lengths))
        steps = [
            _step(_slopes(x, y, w, beta) + part, beta, pull=1.0)
            for x, beta, part in zip(own, betas, np.split(sums, [lengths[0]]), strict=True)
        ]
        betas = [beta + np.clip(step, -3.0, 3.0) for beta, step in zip(betas, steps, strict=True)]
        if max(np.abs(step).max() for step in steps) < 1e-6:
            break
    return tuple(View(*scale, beta) for scale, beta in zip(scales, betas, strict=True))


@dataclass(frozen=True)
class CoModel:
    """Both views, the calibration of each (slope, constant), and the weights that combine them.

    Without views every document has the probability ``usual``.
    """

    usual: float
    views: tuple[View, View] | None = None
    calibrated: tuple[np.ndarray, np.ndarray] | None = None
    combined: np.ndarray | None = None

    def score(self, content: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities by the text, by the page, and by both."""
        if self.views is None:
            same = np.full(len(content), self.usual)
            return same, same, same
        sides = [
            v.logits(x) * c[0] + c[1]
            for v, x, c in zip(self.views, (content, page), self.calibrated, strict=True)
        ]
        both = np.column_stack(sides) @ self.combined[:-1] + self.combined[-1]
        return _sigmoid(sides[0]), _sigmoid(sides[1]), _sigmoid(both)


def co_train(
    labelled: tuple[np.ndarray, np.ndarray],
    y: np.ndarray,
    pool: tuple[np.ndarray, np.ndarray] | Over,
    rounds: int = ROUNDS,
    weights: np.ndarray | None = None,
) -> CoModel:
    """Fit both views in rounds: all that one is sure of among the pool become pseudo-labels for the other.

    The pool is given as numbers, or as what sums a function over them.
    ``weights`` say how many rows each labelled one stands for; they count in
    proportion, 1 on average.
    """
    w = np.ones(len(y)) if weights is None or not len(y) else weights / weights.mean()
    usual = float(np.average(y, weights=w)) if len(y) else 1.0
    held = np.arange(len(y)) % CALIBRATION == 0
    if any(not 0 < y[part].sum() < part.sum() for part in (held, ~held)):
        return CoModel(usual)
    over = pool if callable(pool) else lambda part, size: part(*pool)
    past: list[Views] = []
    for _ in range(rounds + 1):
        past.append(fit_views(tuple(x[~held] for x in labelled), y[~held], w[~held], over, past.copy()))
    views = past[-1]
    logits = [v.logits(x[held]) for v, x in zip(views, labelled, strict=True)]
    calibrated = [_regression(z[:, None], y[held], w[held], pull=1e-2) for z in logits]
    sides = np.column_stack([z * c[0] + c[1] for z, c in zip(logits, calibrated, strict=True)])
    return CoModel(usual, views, tuple(calibrated), _regression(sides, y[held], w[held], pull=1e-2))


def _numbers() -> Column:
    """``array<double>`` of both views, the text's first."""

    @F.arrow_udf("array<double>")
    def numbers(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        rows = zip(text, lang.to_pylist(), source.to_pylist(), n_chars.to_pylist(), strict=True)
        found = [
            content_numbers(t.as_py() or "") + page_numbers(t.as_py() or "", la, so, n) for t, la, so, n in rows
        ]
        return pa.array(found, pa.list_(pa.float64()))

    return numbers


def _inputs(df: DataFrame, text_column: str) -> list[Column]:
    """Text, language, source and size; what the table lacks is NULL."""
    kinds = {text_column: "string", "lang": "string", "source": "string", "n_chars": "long"}
    return [(F.col(c) if c in df.columns else F.lit(None)).cast(k) for c, k in kinds.items()]


def _gathered(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of a bounded sample as two matrices, its labels and weights, in order of the id's hash."""
    found = rows.orderBy(F.xxhash64("_id"), "_numbers").select("_numbers", "_label", "_weight").toArrow()
    content, page = _matrices(found.column("_numbers").combine_chunks())
    labels, weights = (np.array(found.column(c).to_pylist(), dtype=float) for c in ("_label", "_weight"))
    return content, page, labels, weights


def _matrices(numbers: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    n = len(content_numbers("a"))
    width = n + len(page_numbers("a", None, None, None))
    matrix = numbers.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return matrix[:, :n], matrix[:, n:]


def _over(rows: DataFrame) -> Over:
    """Sums over the column ``_numbers``: one row of sums for each task reaches the driver."""

    def over(part: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                total += part(*_matrices(batch.column("_numbers")))
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])

        found = rows.mapInArrow(added, "sums array<double>").toArrow().column("sums")
        return np.sum([np.zeros(size), *(x.values.to_numpy() for x in found)], axis=0)

    return over


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    most_rows: int = LABELLED_ROWS,
    rounds: int = ROUNDS,
) -> CoModel:
    """Co-train on ``most_rows`` labelled rows of each label at most, and on all rows without a label.

    Labelled rows are weighted to the shares of all labels. The numbers of all
    rows are written once; only those of the labelled sample reach the driver,
    and of the others sums of a fixed size for each task. NULL labels and ids are
    left out. Without both labels the model is the share of good rows, or 1
    without any label.
    """
    spark = docs.sparkSession
    made = docs.select(F.col(id_column).alias("_id"), _numbers()(*_inputs(docs, text_column)).alias("_numbers"))
    numbers, first = written(made.filter("_id is not null"), "numbers")
    known, second = written(labels.select(F.col(id_column).alias("_key")).dropna().distinct(), "known")
    others = numbers.join(known, F.col("_id") == F.col("_key"), "left_anti").select("_numbers")
    pool, third = written(others, "pool")
    named = labels.withColumnRenamed(id_column, "_id")
    content, page, y, weights = _gathered(labelled_sample(numbers, named, label_column, "_id", most_rows))
    model = co_train((content, page), y, _over(pool), rounds, weights)
    drop(spark, first, second, third)
    return model


def score_quality(df: DataFrame, model: CoModel, text_column: str = "text", out: str = "quality") -> DataFrame:
    """Every row with the column ``out``, a struct of ``by_text, by_page, probability``.

    A NULL text counts as empty; NULL or missing ``lang``, ``source`` and
    ``n_chars`` are no input. Repeated rows and NULL ids are scored like others.
    The text goes to Python and is not carried back.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("by_text double, by_page double, probability double")
    def score(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        content, page = [], []
        rows = zip(text, lang.to_pylist(), source.to_pylist(), n_chars.to_pylist(), strict=True)
        for cell, la, so, n in rows:
            whole = cell.as_py() or ""
            content.append(content_numbers(whole))
            page.append(page_numbers(whole, la, so, n))
        if not content:
            columns = [np.zeros(0)] * 3
        else:
            columns = shared.value.score(np.array(content), np.array(page))
        return pa.StructArray.from_arrays(
            [pa.array(c, pa.float64()) for c in columns], ["by_text", "by_page", "probability"]
        )

    return df.withColumn(out, score(*_inputs(df, text_column)))
