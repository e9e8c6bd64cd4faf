from pathlib import Path

import numpy as np
import pytest
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from headingflow.operators import logistic as passes
from headingflow.operators.model import logistic
from headingflow.operators.sums import CLEANUP, THIN, add_grouped, summed


@pytest.fixture(scope="module")
def rows(spark):
    """Counts of 30 features, one of them never seen, some rows as dense vectors and one without any."""
    chance = np.random.default_rng(3)
    made = []
    for i in range(300):
        label = int(chance.integers(4))
        counts = chance.poisson(np.where(np.arange(30) % 4 == label, 0.9, 0.3)) * (np.arange(30) != 17)
        counts = counts * (i > 0)
        some = np.flatnonzero(counts)
        made.append((Vectors.dense(counts) if i % 3 == 0 else Vectors.sparse(30, some, counts[some]), float(label)))
    return spark.createDataFrame(made, ["features", "label_id"]).repartition(3).cache()


@pytest.mark.parametrize("dense", [0, 8, 64])
def test_products_of_a_block(rows, monkeypatch, dense):
    monkeypatch.setattr(passes, "DENSE", dense)
    monkeypatch.setattr(passes, "ENTRIES", 50)
    table = rows.selectExpr("features", "int(label_id) as label").toArrow()
    whole = np.array([r["features"].toArray() for r in rows.collect()])
    weights, errors = np.random.default_rng(5).normal(size=(30, 4)), np.random.default_rng(6).normal(size=(300, 4))
    (packed,) = passes._packed(iter(table.combine_chunks().to_batches()))
    block = passes.Block(packed.to_pylist()[0])
    assert np.allclose(block.margins(weights.astype("f4")), whole @ weights, atol=1e-4)
    total = np.ones((30, 4))
    block.add_back(total, errors)
    assert np.allclose(total, 1 + whole.T @ errors, atol=1e-4)


def test_the_fit_is_that_of_spark(rows):
    plain = LogisticRegression(family="multinomial", regParam=1e-2, maxIter=200, tol=1e-10, labelCol="label_id").fit(rows)
    ours = logistic(1e-2, 200).setTol(1e-10).fit(rows)
    assert isinstance(logistic(), passes.BlockLogistic) and not ours.hasSummary
    assert np.allclose(ours.coefficientMatrix.toArray(), plain.coefficientMatrix.toArray(), atol=2e-3)
    assert np.allclose(ours.interceptVector.toArray(), plain.interceptVector.toArray(), atol=2e-3)
    assert ours.objective_history[0] == pytest.approx(plain.summary.objectiveHistory[0], abs=1e-6)
    assert ours.objective_history[-1] == pytest.approx(plain.summary.objectiveHistory[-1], abs=1e-6)
    same = [a["prediction"] == b["prediction"] for a, b in zip(ours.transform(rows).collect(), plain.transform(rows).collect())]
    assert sum(same) >= 299


def test_sums_of_all_rows(spark):
    counted = spark.range(0, 300, 1, 7)
    held = summed(counted, 100, lambda total, row: np.add(total, row["id"], out=total))
    assert (held == 299 * 150).all()
    assert (summed(counted.filter("id < 0"), 5, lambda total, row: None) == 0).all()


def test_minimise_reaches_the_bottom():
    bent = lambda x: (float(((x - 3) ** 4).sum() + (x**2).sum()), 4 * (x - 3) ** 3 + 2 * x)
    x, history = passes.minimise(bent, np.zeros(3), 60, 1e-9)
    assert np.abs(bent(x)[1]).max() < 1e-4 and all(b < a for a, b in zip(history, history[1:]))


@pytest.mark.parametrize("at_once", [3, 1000])
def test_grouped_products_are_added(at_once):
    """Rows without an entry, with a few and with many."""
    chance = np.random.default_rng(7)
    sizes = np.array([0, 1, 2, THIN, THIN + 1, 40, 0, 3, 90, 1])
    rows = np.repeat(np.arange(10), sizes)
    places, values, table = chance.integers(0, 20, len(rows)), chance.normal(size=len(rows)), chance.normal(size=(20, 6))
    out, want = np.ones((10, 6)), np.ones((10, 6))
    np.add.at(want, rows, values[:, None] * table[places])
    add_grouped(out, rows, places, values, table, at_once)
    assert np.allclose(out, want)
    add_grouped(out, rows[:0], places[:0], values[:0], table, at_once)
    assert np.allclose(out, want)


def test_fits_to_the_same_rows_share_their_passes(rows, monkeypatch):
    passed, add_up = [], passes.summed
    monkeypatch.setattr(passes, "summed", lambda table, size, add: passed.append(size) or add_up(table, size, add))
    alone = [logistic(1e-2, 8).fit(rows), logistic(1e-1, 6).fit(rows)]
    each = len(passed)
    made = passes.fit_together([logistic(1e-2, 8), logistic(1e-1, 6)], rows)
    # One pass for both in place of one for each, and the moments once.
    assert len(passed) - each <= each - 1 - 6
    for one, other in zip(alone, made, strict=True):
        assert one.objective_history == pytest.approx(other.objective_history)
        assert np.allclose(one.coefficientMatrix.toArray(), other.coefficientMatrix.toArray(), atol=1e-4)


def test_fits_too_large_for_the_driver_go_one_by_one(rows, monkeypatch):
    sizes, add_up = [], passes.summed
    monkeypatch.setattr(passes, "summed", lambda table, size, add: sizes.append(size) or add_up(table, size, add))
    monkeypatch.setattr(passes, "CELLS", 239)
    made = passes.fit_together([logistic(1e-2, 3), logistic(1e-1, 3)], rows)
    assert len(made) == 2 and set(sizes[1:]) == {30 * 4 + 4 + 1}
    assert made[0].objective_history[0] < made[1].objective_history[0] + 1e-9 and made[0].objective_history[-1] < made[1].objective_history[-1]


def test_no_more_tasks_than_cores_send_sums(spark):
    """What is shuffled in a pass must not grow with the parts of the table."""
    cores = spark.sparkContext.defaultParallelism

    def add(total, row):
        total[TaskContext.get().partitionId()] += 1

    seen = summed(spark.range(0, 600, 1, 60), 60, add)
    assert seen.sum() == 600 and np.count_nonzero(seen) == cores < 60


def test_a_pass_leaves_no_shuffle_files(spark):
    """Those of all passes of a fit would outgrow a small input many times."""
    folders = [Path(f.getPath()) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f.name for folder in folders for f in folder.rglob("shuffle_*.data")}
    before = files()
    assert summed(spark.range(0, 100, 1, 4), 1000, lambda total, row: np.add(total, 1, out=total))[0] == 100
    assert not files() - before
    assert spark.conf.get(CLEANUP) == "false"
