"""A classifier of averaged word and department embeddings, trained in epochs with early stopping.

A question is the mean of the vectors of its words beside the vector of its
department. A dense layer of rectified units goes over both, some of them are
left out at each step, and the class scores are the softmax of a linear layer.
The model's size is words times the width of the vectors plus classes times the
units, so thousands of headings cost no more than some thousand further words.

The rows are packed once into blocks of one share each, and an epoch is a step
for every share: the whole train part. A pass sums the gradients of a share over
all tasks; the first pass after an epoch also measures its weights on the whole
validation part.
"""

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headingflow.functions.text import clean_question
from headingflow.functions.values import text_or_empty
from headingflow.operators.guards import require_columns, with_default
from headingflow.operators.labels import dictionary, encode
from headingflow.operators.model import label_width, predict_from_scores
from headingflow.operators.split import SEED
from headingflow.operators.sums import add_grouped, summed
from headingflow.operators.vocabulary import MAX_LENGTH, NUM_WORDS, encode_sequences, vocabulary
from headingflow.sources.shared import discard, materialise

WIDTH, EPOCHS, PATIENCE, SHARES, RATE = 32, 60, 8, 2, 0.1
DEPARTMENT_WIDTH, UNITS, DROPPED = 8, 256, 0.25
#: The rate falls to this part of it when the validation loss does not fall, not below the last.
SLOWER, LEAST_FALL, LEAST_RATE = 0.5, 1e-4, 1e-6
#: In place of a share: the validation part alone.
NO_SHARE = -1
#: Questions that go through the network at once: of a block, and when scored.
BLOCK_ROWS, ROWS_AT_ONCE = 4096, 512

_PACKED = "share int, sizes binary, words binary, counts binary, turned binary, departments binary, labels binary"

Weights = dict[str, np.ndarray]


@dataclass(frozen=True)
class Epoch:
    """Mean loss of the steps of an epoch, and what the weights after them are worth."""

    epoch: int
    loss: float
    val_top1: float
    val_loss: float
    rate: float


def encoded(df: DataFrame, words: DataFrame, departments: DataFrame) -> DataFrame:
    """Add ``word_ids`` without padding and ``department_id``, NULL for a department not seen in training."""
    ids = encode_sequences(df, words, "question_clean", "word_ids", MAX_LENGTH)
    ids = ids.withColumn("word_ids", F.filter("word_ids", lambda i: i > 0))
    return encode(ids, departments, "department", "department_id")


@dataclass(frozen=True)
class Bags:
    """The different words of each question, how often each of them occurs, and the departments (-1 for none).

    ``sizes`` are different words of a question, ``turned`` the order of all by word.
    """

    sizes: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    turned: np.ndarray
    departments: np.ndarray

    @staticmethod
    def of(flat: np.ndarray, lengths: np.ndarray, departments: np.ndarray) -> "Bags":
        """From the words of all questions and how many each question has."""
        at = np.repeat(np.arange(len(lengths)), lengths)
        both, counts = np.unique(at << 32 | flat.astype(np.int64), return_counts=True)
        words = (both & 0xFFFFFFFF).astype("<i4")
        sizes = np.bincount(both >> 32, minlength=len(lengths))
        return Bags(*(x.astype("<i4") for x in (sizes, words, counts, np.argsort(words, kind="stable"), departments)))

    def shares(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each entry the question, and the part of the question's words that it makes up."""
        at, counts = np.repeat(np.arange(len(self.sizes)), self.sizes), self.counts.astype(float)
        return at, counts / np.bincount(at, counts, len(self.sizes))[at]


def _vectors(weights: Weights, bags: Bags) -> np.ndarray:
    """The vector of each question.

    Models without a dense layer, as saved before there was one, add the
    department's vector to the mean of the words'.
    """
    means = np.zeros((len(bags.sizes), weights["words"].shape[1]))
    at, shares = bags.shares()
    add_grouped(means, at, bags.words, shares, weights["words"])
    # A department that training has not seen has no vector.
    known, seen = np.zeros((len(bags.sizes), weights["departments"].shape[1])), bags.departments >= 0
    known[seen] = weights["departments"][bags.departments[seen]]
    return np.hstack([means, known]) if "dense" in weights else means + known


def _units(weights: Weights, vectors: np.ndarray) -> np.ndarray:
    """The rectified units of the dense layer over the vectors."""
    return np.maximum(vectors @ weights["dense"] + weights["dense_bias"], 0) if "dense" in weights else vectors


def _flat(ids: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(i) for i in ids], dtype=np.int64)
    return (np.concatenate(ids).astype(np.int64) if sizes.sum() else np.zeros(0, dtype=np.int64)), sizes


def _softmax(weights: Weights, units: np.ndarray) -> np.ndarray:
    raw = units @ weights["classes"].T + weights["bias"]
    raw = np.exp(raw - raw.max(axis=1, keepdims=True))
    return raw / raw.sum(axis=1, keepdims=True)


def _chances(weights: Weights, bags: Bags) -> np.ndarray:
    return _softmax(weights, _units(weights, _vectors(weights, bags)))


def _loss(chances: np.ndarray, labels: np.ndarray) -> float:
    return float(-np.log(np.maximum(chances[np.arange(len(labels)), labels], 1e-300)).sum())


def _add_gradients(
    total: Weights, weights: Weights, bags: Bags, labels: np.ndarray, kept: np.ndarray | float = 1.0
) -> float:
    """Add the gradients of the cross entropy to the total; its sum.

    ``kept`` has the factor of each unit of each question: 0 for one left out.
    """
    vectors = _vectors(weights, bags)
    units = _units(weights, vectors) * kept
    chances = _softmax(weights, units)
    loss = _loss(chances, labels)
    chances[np.arange(len(labels)), labels] -= 1
    total["classes"] += chances.T @ units
    total["bias"] += chances.sum(axis=0)
    back = chances @ weights["classes"]
    to_words = to_departments = back
    if "dense" in weights:
        back *= (units > 0) * kept
        total["dense"] += vectors.T @ back
        total["dense_bias"] += back.sum(axis=0)
        back = back @ weights["dense"].T
        width = weights["words"].shape[1]
        to_words, to_departments = np.ascontiguousarray(back[:, :width]), back[:, width:]
    known = np.flatnonzero(bags.departments >= 0)
    np.add.at(total["departments"], bags.departments[known], to_departments[known])
    at, shares = bags.shares()
    add_grouped(total["words"], bags.words[bags.turned], at[bags.turned], shares[bags.turned], to_words)
    return loss


def gradients(weights: Weights, ids: list, departments: np.ndarray, labels: np.ndarray) -> tuple[Weights, float]:
    """Summed gradients of the cross entropy, and its sum."""
    total = {name: np.zeros(w.shape) for name, w in weights.items()}
    return total, _add_gradients(total, weights, Bags.of(*_flat(ids), departments), labels)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of questions of one share."""
    names = [c.split()[0] for c in _PACKED.split(", ")]
    for batch in batches:
        shares = batch.column("share").to_numpy(zero_copy_only=False)
        for share in np.unique(shares):
            own = np.flatnonzero(shares == share)
            for at in range(0, len(own), BLOCK_ROWS):
                some = batch.take(pa.array(own[at : at + BLOCK_ROWS]))
                words = some.column("word_ids")
                lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                departments, labels = (some.column(c).fill_null(-1).to_numpy(zero_copy_only=False) for c in ("department_id", "label_id"))
                bags = Bags.of(words.flatten().to_numpy(zero_copy_only=False), lengths, departments)
                parts = [bags.sizes, bags.words, bags.counts, bags.turned, bags.departments, labels.astype("<i4")]
                held = [pa.array([p.tobytes()], pa.binary()) for p in parts]
                yield pa.RecordBatch.from_arrays([pa.array([share], pa.int32()), *held], names=names)


def _epoch_sums(
    blocks: DataFrame, weights: Weights, share: int, measured: bool = True, dropped: float = 0.0, seed: Sequence[int] = ()
) -> tuple[Weights, float, int, int, int]:
    """Gradients, loss and rows of the share, and hits and rows of the validation part if it is to be measured.

    Beside the gradients lies ``val_loss``, the loss of the validation part. The
    units left out follow from the seed and the rows of the block.
    """
    sent = blocks.sparkSession.sparkContext.broadcast(weights)
    size = sum(w.size for w in weights.values()) + 1

    # What ``add`` holds itself goes with the query's plan, and stays on disk when that is large.
    def parted(sums: np.ndarray, like: Weights) -> Weights:
        return _unpacked(sums, like | {"val_loss": np.zeros(1)})

    def add(total: np.ndarray, row: dict) -> None:
        own, sums = sent.value, parted(total[:size], sent.value)
        bags = Bags(*(np.frombuffer(row[c], "<i4") for c in ("sizes", "words", "counts", "turned", "departments")))
        labels = np.frombuffer(row["labels"], "<i4")
        if row["share"] == NO_SHARE:
            chances = _chances(own, bags)
            sums["val_loss"] += _loss(chances, labels)
            total[-2:] += (chances.argmax(axis=1) == labels).sum(), len(labels)
        else:
            kept = 1.0
            if dropped:
                rows = zlib.crc32(row["labels"], zlib.crc32(row["words"]))
                chance = np.random.default_rng([*seed, rows])
                kept = (chance.random((len(labels), own["classes"].shape[1])) >= dropped) / (1 - dropped)
            loss = _add_gradients(sums, own, bags, labels, kept)
            total[-4:-2] += loss, len(labels)

    parts = [share, NO_SHARE] if measured else [share]
    sums = summed(blocks.filter(F.col("share").isin(parts)), size + 4, add)
    sent.destroy()
    loss, n, hits, n_val = sums[size:]
    return parted(sums[:size], weights), float(loss), int(n), int(hits), int(n_val)


def _unpacked(flat: np.ndarray, like: Weights) -> Weights:
    """The arrays that lie in a flat one, by the order of their names."""
    at, out = 0, {}
    for name in sorted(like):
        size = like[name].size
        out[name] = flat[at : at + size].reshape(like[name].shape)
        at += size
    return out


@dataclass(frozen=True)
class EmbeddingModel:
    """Weights, and the tables that give words, departments and headings their numbers."""

    weights: Weights
    words: DataFrame
    departments: DataFrame
    labels: DataFrame

    def scores(self, df: DataFrame, out: str = "scores") -> DataFrame:
        """The input columns, the cleaned question and the class probabilities."""
        sent = df.sparkSession.sparkContext.broadcast(self.weights)

        @F.pandas_udf("array<double>")
        def score(ids: pd.Series, departments: pd.Series) -> pd.Series:
            known, rows = departments.fillna(-1).to_numpy(dtype=np.int64), list(ids)
            found: list[np.ndarray] = []
            for at in range(0, len(rows), ROWS_AT_ONCE):
                some = slice(at, at + ROWS_AT_ONCE)
                found += list(_chances(sent.value, Bags.of(*_flat(rows[some]), known[some])))
            return pd.Series(found, index=ids.index, dtype=object)

        ready = with_default(df, "department", F.lit(""))
        if "question_clean" not in ready.columns:
            ready = ready.withColumn("question_clean", clean_question("question"))
        ready = ready.withColumns({c: text_or_empty(F.col(c)) for c in ("question_clean", "department")})
        made = encoded(ready, self.words, self.departments)
        return made.withColumn(out, score("word_ids", "department_id")).drop("word_ids", "department_id")

    def predict(self, df: DataFrame, k: int = 10, never_other: bool = False) -> DataFrame:
        return predict_from_scores(self.scores(df), self.labels, k, never_other=never_other)

    def save(self, path: str) -> None:
        spark = self.labels.sparkSession
        rows = [(name, list(w.shape), bytearray(w.astype("<f8").tobytes())) for name, w in self.weights.items()]
        tables = {"weights": spark.createDataFrame(rows, "name string, shape array<int>, data binary")}
        tables |= {"words": self.words, "departments": self.departments, "label_map": self.labels}
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "EmbeddingModel":
        # One row for each of the arrays of the model.
        rows = spark.read.parquet(f"{path}/weights").collect()
        weights = {r["name"]: np.frombuffer(bytes(r["data"]), "<f8").reshape(r["shape"]) for r in rows}
        return EmbeddingModel(weights, *(spark.read.parquet(f"{path}/{n}") for n in ("words", "departments", "label_map")))


def _first_weights(
    num_words: int, departments: int, classes: int, width: int, department_width: int, units: int, seed: int
) -> Weights:
    """Small vectors, and layers whose weights lie evenly within a bound set by their size."""
    chance = np.random.default_rng(seed)

    def layer(inputs: int, outputs: int, shape: tuple[int, int]) -> np.ndarray:
        bound = np.sqrt(6 / (inputs + outputs))
        return chance.uniform(-bound, bound, shape)

    joined = width + department_width
    return {
        "words": chance.normal(0, 0.1, (num_words, width)),
        "departments": chance.normal(0, 0.1, (departments, department_width)),
        "dense": layer(joined, units, (joined, units)),
        "dense_bias": np.zeros(units),
        "classes": layer(units, classes, (classes, units)),
        "bias": np.zeros(classes),
    }


class _Adam:
    """Means of the gradients and of their squares, and the weights after a step."""

    def __init__(self, weights: Weights):
        self.mean, self.spread = ({n: np.zeros(w.shape) for n, w in weights.items()} for _ in range(2))
        self.steps = 0

    def after(self, weights: Weights, gradients: Weights, rate: float) -> Weights:
        self.steps += 1
        made = {}
        for name, w in weights.items():
            g = gradients[name]
            self.mean[name] = 0.9 * self.mean[name] + 0.1 * g
            self.spread[name] = 0.99 * self.spread[name] + 0.01 * g * g
            size = np.sqrt(self.spread[name] / (1 - 0.99**self.steps)) + 1e-8
            made[name] = w - rate * self.mean[name] / (1 - 0.9**self.steps) / size
        return made


def fit_embedding(
    training: DataFrame,
    labels: DataFrame,
    width: int = WIDTH,
    epochs: int = EPOCHS,
    patience: int = PATIENCE,
    shares: int = SHARES,
    rate: float = RATE,
    seed: int = SEED,
    num_words: int = NUM_WORDS,
    department_width: int = DEPARTMENT_WIDTH,
    units: int = UNITS,
    dropped: float = DROPPED,
    words: DataFrame | None = None,
) -> tuple[EmbeddingModel, list[Epoch]]:
    """Fit on the train part of a prepared training table; also the history of all epochs.

    An epoch is a step of Adam for each share of the train part, so it takes
    every row once. Its weights are measured on the whole validation part. The
    rate is halved after each epoch whose validation loss is no lower than the
    least before. Training ends after ``epochs``, or when the validation top-1
    has not risen for ``patience`` epochs, and the weights of the first epoch
    with the best top-1 are kept. Without a validation part the last weights are.
    The vocabulary is that of the train part, made here if ``words`` is not given.
    """
    require_columns(training, ("question_clean", "department", "label_id", "heading_collapsed", "split"))
    train_rows = training.filter(F.col("split") == "train")
    words = vocabulary(train_rows, "question_clean", num_words) if words is None else words
    departments = dictionary(train_rows, "department", "department_id")
    share = F.when(F.col("split") == "train", F.pmod(F.xxhash64("question_clean", "department"), F.lit(shares))).otherwise(NO_SHARE)
    rows = encoded(training, words, departments).select("word_ids", "department_id", "label_id", share.cast("int").alias("share"))
    blocks = materialise(rows.mapInArrow(_packed, _PACKED), "blocks")
    weights = _first_weights(num_words, departments.count(), label_width(labels), width, department_width, units, seed)
    steps = _Adam(weights)
    history: list[Epoch] = []
    best, best_top1, least_loss, since, trained = weights, -1.0, np.inf, 0, 0.0
    for epoch in range(epochs + 1):
        total, rows = 0.0, 0
        # After the last epoch the validation part alone is read.
        for share in range(shares) if epoch < epochs else [NO_SHARE]:
            measured = epoch > 0 and share <= 0
            sums, loss, n, hits, n_val = _epoch_sums(blocks, weights, share, measured, dropped, (seed, epoch, share + 1))
            if measured:
                top1, val_loss = (hits / n_val, float(sums["val_loss"][0]) / n_val) if n_val else (np.nan, np.nan)
                history.append(Epoch(epoch, trained, top1, val_loss, rate))
                if not n_val or top1 > best_top1:
                    best, best_top1, since = weights, top1, 0
                else:
                    since += 1
                if since >= patience:
                    break
                if val_loss < least_loss - LEAST_FALL:
                    least_loss = val_loss
                elif n_val:
                    rate = max(rate * SLOWER, LEAST_RATE)
            if n:
                weights = steps.after(weights, {name: sums[name] / n for name in weights}, rate)
            total, rows = total + loss, rows + n
        if since >= patience:
            break
        trained = total / max(rows, 1)
    discard(blocks)
    return EmbeddingModel(best, words, departments, labels), history
