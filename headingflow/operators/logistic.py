"""Multinomial logistic regression of sparse counts: Spark ML's estimator with passes of its own.

Objective, start and steps are those of ``LogisticRegression``: standardised
features, a penalty on their weights, L-BFGS with ten corrections. The rows are
packed once into blocks. A pass multiplies the first features of a block, the
frequent words, as a dense matrix and gathers the others' weights; Spark's own
walks the weights of all features once for each class. The tasks' gradients are
added up in slices of the features, and the steps are the driver's. Fits to the
same rows share their blocks, and their passes while that many weights fit the
driver.
"""

from collections.abc import Callable, Generator, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headingflow.operators.sums import add_grouped, summed
from headingflow.sources.shared import discard, materialise

BLOCK_ROWS = 4096
#: Features from the first on that are multiplied as a dense matrix.
DENSE = 2048
#: Rows, or features beyond the dense ones, whose sums are made at once.
ENTRIES = 1 << 11
CORRECTIONS, TRIES = 10, 20
#: Weights of the fits that share a pass: the driver holds some thirty numbers for each.
CELLS = 2_000_000

_PACKED = "labels binary, sizes binary, ids binary, counts binary, turned binary"


def _entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of each vector, and the feature and value of all; zeros of a dense vector are none."""
    sizes, ids, values = [], [], []
    for place, held in zip(vectors.field("indices"), vectors.field("values"), strict=True):
        value = held.values.to_numpy()
        at = np.flatnonzero(value)
        # A dense vector has no list of its features.
        ids.append((place.values.to_numpy()[at] if place.is_valid else at).astype("<i4"))
        values.append(value[at].astype("<f4"))
        sizes.append(len(at))
    return np.array(sizes, dtype="<i4"), np.concatenate(ids), np.concatenate(values)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _PACKED.split(", ")]
    for batch in (b.slice(at, BLOCK_ROWS) for b in batches for at in range(0, len(b), BLOCK_ROWS)):
        sizes, ids, values = _entries(batch.column("features"))
        labels = batch.column("label").to_numpy(zero_copy_only=False).astype("<i4")
        # The order of the entries by feature, of those beyond the dense part.
        rare = np.flatnonzero(ids >= DENSE)
        turned = np.argsort(ids[rare], kind="stable").astype("<i4")
        parts = [labels, sizes, ids, values, turned]
        yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=names)


class Block:
    """Rows of counts: a dense matrix of the first features, and the entries of the others by row and by feature."""

    def __init__(self, row: dict):
        self.labels = np.frombuffer(row["labels"], "<i4")
        sizes = np.frombuffer(row["sizes"], "<i4")
        ids, counts = np.frombuffer(row["ids"], "<i4"), np.frombuffer(row["counts"], "<f4")
        self.n = len(sizes)
        self.all = ids, counts
        at = np.repeat(np.arange(self.n), sizes)
        first = ids < DENSE
        self.dense = np.zeros((self.n, DENSE), dtype=np.float32)
        self.dense[at[first], ids[first]] = counts[first]
        self.at, self.ids, self.counts = at[~first], ids[~first], counts[~first]
        self.turned = np.frombuffer(row["turned"], "<i4")

    def margins(self, weights: np.ndarray) -> np.ndarray:
        wide = weights[:DENSE]
        out = self.dense[:, : len(wide)] @ wide
        add_grouped(out, self.at, self.ids, self.counts, weights, ENTRIES)
        return out

    def add_back(self, total: np.ndarray, errors: np.ndarray) -> None:
        """Add the product of the turned counts and the errors of the rows."""
        narrow = errors.astype(np.float32)
        wide = total[:DENSE]
        wide += self.dense[:, : len(wide)].T @ narrow
        add_grouped(total, self.ids[self.turned], self.at[self.turned], self.counts[self.turned], narrow, ENTRIES)


def _moments(blocks: DataFrame, features: int, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and deviation of each feature, and rows of each class."""

    def add(total: np.ndarray, row: dict) -> None:
        block = Block(row)
        ids, counts = block.all
        total[:features] += np.bincount(ids, counts, features)
        total[features : 2 * features] += np.bincount(ids, counts.astype(float) ** 2, features)
        total[2 * features :] += np.bincount(block.labels, minlength=classes)

    sums = summed(blocks, 2 * features + classes, add)
    first, second, rows = np.split(sums, [features, 2 * features])
    n = rows.sum()
    mean = first / n
    return mean, np.sqrt(np.maximum(second - n * mean * mean, 0) / max(n - 1, 1)), rows


def _direction(gradient: np.ndarray, steps: list, changes: list) -> np.ndarray:
    """The step of L-BFGS."""
    # One correction at a time is held in double precision.
    double = lambda held: held.astype(float, copy=False)
    out, held = -gradient, []
    for s, y in zip(map(double, reversed(steps)), map(double, reversed(changes)), strict=True):
        a = (s @ out) / (s @ y)
        held.append(a)
        out -= a * y
    if steps:
        s, y = double(steps[-1]), double(changes[-1])
        out *= (s @ y) / (y @ y)
    for s, y, a in zip(map(double, steps), map(double, changes), reversed(held), strict=True):
        out += (a - (y @ out) / (s @ y)) * s
    return out


Descent = Generator[np.ndarray, tuple[float, np.ndarray], tuple[np.ndarray, list[float]]]


def _descent(x: np.ndarray, max_iter: int, tol: float) -> Descent:
    """L-BFGS; gives the points whose value and gradient it is to be sent.

    Returns the point reached, and the value at the start and after each step.
    Corrections are held in single precision.
    """
    value, gradient = yield x
    history, steps, changes = [value], [], []
    for turn in range(max_iter):
        if np.linalg.norm(gradient) <= max(tol * abs(value), 1e-8):
            break
        way = _direction(gradient, steps, changes)
        slope = way @ gradient
        if slope >= 0:
            steps, changes, way = [], [], -gradient
            slope = way @ gradient
        low, high, size = 0.0, np.inf, 1.0 if turn else 1 / np.linalg.norm(way)
        for _ in range(TRIES):
            there, new = yield x + size * way
            if not there <= value + 1e-4 * size * slope:
                high = size
            elif way @ new < 0.9 * slope:
                low = size
            else:
                break
            size = 2 * low if np.isinf(high) else (low + high) / 2
        if not there < value:
            break
        step = size * way
        steps = [*steps, step.astype(np.float32)][-CORRECTIONS:]
        changes = [*changes, (new - gradient).astype(np.float32)][-CORRECTIONS:]
        x, value, gradient = x + step, there, new
        history.append(value)
        if abs(value - np.mean(history[-20:])) <= tol * abs(history[0]):
            break
    return x, history


def minimise_together(
    evaluate: Callable[[dict[int, np.ndarray]], dict[int, tuple[float, np.ndarray]]], descents: Sequence[Descent]
) -> list[tuple[np.ndarray, list[float]]]:
    """What each descent returns; the points of all that go on are evaluated at once."""
    points, ended = {i: next(d) for i, d in enumerate(descents)}, {}
    while points:
        for i, found in evaluate(points).items():
            try:
                points[i] = descents[i].send(found)
            except StopIteration as end:
                ended[i] = end.value
                del points[i]
    return [ended[i] for i in range(len(descents))]


def minimise(
    evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, max_iter: int, tol: float
) -> tuple[np.ndarray, list[float]]:
    """L-BFGS; the point reached, and the value at the start and after each step."""
    (made,) = minimise_together(lambda points: {i: evaluate(x) for i, x in points.items()}, [_descent(x, max_iter, tol)])
    return made


class BlockLogistic(LogisticRegression):
    """``LogisticRegression`` of the multinomial family with a plain L2 penalty, fitted over packed blocks.

    The model is Spark ML's; ``objective_history`` has the value of each
    iteration. Whole numbers below 2^24 are held exactly, other values and the
    margins in single precision, all sums in double.
    """

    def plain(self) -> bool:
        """Whether the fit is one over blocks."""
        usual = self.getElasticNetParam() == 0 and self.getFitIntercept() and self.getStandardization()
        return self.getFamily() == "multinomial" and usual and not self.isSet(self.weightCol)

    def _fit(self, dataset: DataFrame) -> LogisticRegressionModel:
        return fit_together([self], dataset)[0] if self.plain() else super()._fit(dataset)


def fit_together(estimators: Sequence[BlockLogistic], dataset: DataFrame) -> list[LogisticRegressionModel]:
    """The models of plain estimators of the same columns; a pass over the rows serves as many as ``CELLS`` allows."""
    ((features, label),) = {(e.getFeaturesCol(), e.getLabelCol()) for e in estimators}
    rows = dataset.select(F.col(features).alias("features"), F.col(label).cast("int").alias("label"))
    blocks = materialise(rows.mapInArrow(_packed, _PACKED), "blocks")
    width = rows.first()["features"].size
    classes = rows.agg(F.max("label")).first()[0] + 1
    mean, deviation, counts = _moments(blocks, width, classes)
    scale = np.divide(1, deviation, out=np.zeros(width), where=deviation > 0)[:, None]
    n, cells, context = counts.sum(), width * classes, dataset.sparkSession.sparkContext

    def in_use(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weights = x[:cells].reshape(width, classes) * scale
        return weights, x[cells:] - mean @ weights

    def evaluate(regs: list[float], points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        k = len(points)
        held, offsets = np.empty((width, k * classes), np.float32), np.empty((k, classes))
        for j, x in enumerate(points.values()):
            held[:, j * classes : (j + 1) * classes], offsets[j] = in_use(x)
        sent = context.broadcast((held, offsets))
        ends = np.cumsum([k * cells, k * classes])

        def add(total: np.ndarray, row: dict) -> None:
            block, (weights, offsets) = Block(row), sent.value
            margins = block.margins(weights).reshape(block.n, k, classes) + offsets
            margins -= margins.max(axis=2, keepdims=True)
            chances = np.exp(margins)
            whole = chances.sum(axis=2, keepdims=True)
            at = np.arange(block.n)
            turned, errors, losses = np.split(total, ends)
            losses += (np.log(whole[:, :, 0]) - margins[at, :, block.labels]).sum(axis=0)
            chances /= whole
            chances[at, :, block.labels] -= 1
            chances = chances.reshape(block.n, k * classes)
            block.add_back(turned.reshape(width, k * classes), chances)
            errors += chances.sum(axis=0)

        sums = summed(blocks, k * (cells + classes + 1), add)
        sent.destroy()
        sums /= n
        turned, errors, losses = np.split(sums, ends)
        turned, errors, made = turned.reshape(width, k, classes), errors.reshape(k, classes), {}
        for j, (i, x) in enumerate(points.items()):
            reg, own = regs[i], x[:cells]
            gradient = np.empty(len(x))
            gradient[cells:] = errors[j]
            inner = gradient[:cells].reshape(width, classes)
            np.multiply(-mean[:, None], errors[j], out=inner)
            inner += turned[:, j]
            inner *= scale
            inner += reg * own.reshape(width, classes)
            made[i] = losses[j] + reg / 2 * (own @ own), gradient
        return made

    start = np.log1p(counts)
    start = np.concatenate([np.zeros(cells), start - start.mean()])
    found, at_once = [], max(1, CELLS // cells)
    for some in (estimators[at : at + at_once] for at in range(0, len(estimators), at_once)):
        descents = [_descent(start, e.getMaxIter(), e.getTol()) for e in some]
        found += minimise_together(partial(evaluate, [e.getRegParam() for e in some]), descents)
    discard(blocks)
    models = []
    for estimator, (x, history) in zip(estimators, found, strict=True):
        weights, offset = in_use(x)
        matrix = _py2java(context, DenseMatrix(classes, width, weights.ravel()))
        intercepts = _py2java(context, DenseVector(offset - offset.mean()))
        made = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel
        model = LogisticRegressionModel(made(f"{estimator.uid}_model", matrix, intercepts, classes, True))
        model.objective_history = history
        models.append(estimator._copyValues(model))
    return models
