import numpy as np
import pytest
from pyspark.sql import functions as F

from headingflow.operators import embedding
from headingflow.operators import model as models
from headingflow.operators.embedding import EmbeddingModel, fit_embedding, gradients
from headingflow.operators.model import HeadingModel, _LOADED, label_width, loaded, logistic, naive_bayes, plugin_scores, sweep, train
from headingflow.operators.vocabulary import vocabulary
from headingflow.plans.training import prepare_training


@pytest.fixture(scope="module")
def prepared(spark):
    """Headings that words or the department tell, some of them rare."""
    topics = {"homes": ["rent", "house"], "health": ["nurse", "beds"], "schools": ["exam", "pupil"]}
    rows = []
    for i in range(240):
        name = list(topics)[i % 3]
        words = topics[name] if i % 2 else ["thing", "other"]
        text = f"asked about {words[i % 2]} and {words[(i // 2) % 2]} number {i % 7}"
        rows.append((i, text, None if i % 11 == 0 else f"dept-{name}", name if i < 237 else "rare"))
    return prepare_training(spark.createDataFrame(rows, "id long, question string, department string, heading string"), "id")


def test_gradients_are_those_of_the_loss():
    chance = np.random.default_rng(1)
    weights = {
        "words": chance.normal(size=(9, 4)), "departments": chance.normal(size=(3, 4)),
        "classes": chance.normal(size=(5, 4)), "bias": chance.normal(size=5),
    }
    ids = [np.array(x, dtype=np.int64) for x in ([2, 3, 3], [], [8], [1, 2, 4, 5])]
    departments, labels = np.array([0, 2, -1, -1]), np.array([1, 4, 0, 0])
    made, _ = gradients(weights, ids, departments, labels)
    for name, w in weights.items():
        for place in np.ndindex(w.shape):
            sides = []
            for d in (1e-6, -1e-6):
                moved = {n: x.copy() for n, x in weights.items()}
                moved[name][place] += d
                sides.append(gradients(moved, ids, departments, labels)[1])
            assert made[name][place] == pytest.approx((sides[0] - sides[1]) / 2e-6, abs=1e-5)


def whole_network(chance):
    """Vectors of departments beside those of words, and a dense layer over both."""
    return {
        "words": chance.normal(size=(9, 4)), "departments": chance.normal(size=(3, 2)),
        "dense": chance.normal(size=(6, 7)), "dense_bias": chance.normal(size=7),
        "classes": chance.normal(size=(5, 7)), "bias": chance.normal(size=5),
    }


def test_gradients_of_the_whole_network_are_those_of_the_loss():
    weights = whole_network(np.random.default_rng(3))
    ids = [np.array(x, dtype=np.int64) for x in ([2, 3, 3], [], [8], [1, 2, 4, 5])]
    departments, labels = np.array([0, 2, -1, -1]), np.array([1, 4, 0, 0])
    made, _ = gradients(weights, ids, departments, labels)
    for name, w in weights.items():
        for place in np.ndindex(w.shape):
            sides = []
            for d in (1e-6, -1e-6):
                moved = {n: x.copy() for n, x in weights.items()}
                moved[name][place] += d
                sides.append(gradients(moved, ids, departments, labels)[1])
            assert made[name][place] == pytest.approx((sides[0] - sides[1]) / 2e-6, abs=1e-5)


def test_units_are_left_out_at_each_step_but_not_when_measured(spark):
    weights = whole_network(np.random.default_rng(4))
    rows = [([2 + i % 7, 3], i % 3, i % 5, i % 2 - 1) for i in range(60)]
    table = spark.createDataFrame(rows, "word_ids array<int>, department_id int, label_id int, share int")
    blocks = table.mapInArrow(embedding._packed, embedding._PACKED).cache()
    made = [embedding._epoch_sums(blocks, weights, 0, True, dropped, seed) for dropped, seed in ((0, ()), (0.5, (1,)), (0.5, (1,)), (0.5, (2,)))]
    losses = [m[1] for m in made]
    assert losses[1] == pytest.approx(losses[2]) and len({round(x, 6) for x in losses}) == 3
    assert len({(m[2], m[3], m[4], round(float(m[0]["val_loss"][0]), 6)) for m in made}) == 1
    # A unit left out of a question has no part in its gradient; those kept are scaled.
    alone = spark.createDataFrame([([2], 0, 1, 0)], table.schema).mapInArrow(embedding._packed, embedding._PACKED)
    whole, part = (embedding._epoch_sums(alone, weights, 0, False, dropped, (1,))[0]["classes"] for dropped in (0, 0.5))
    on = (whole != 0).any(axis=0)
    assert on.any() and not part[:, ~on].any() and {bool(x) for x in (part[:, on] != 0).all(axis=0)} == {True, False}


def test_an_epoch_takes_every_row_of_the_train_part_once(prepared, monkeypatch):
    training, labels = prepared
    n_train, n_val = (training.filter(F.col("split") == part).count() for part in ("train", "val"))
    passes, sums = [], embedding._epoch_sums

    def watched(blocks, weights, share, measured=True, *others):
        made = sums(blocks, weights, share, measured, *others)
        passes.append((share, measured, made[2], made[4], {name: w.shape for name, w in weights.items()}))
        return made

    monkeypatch.setattr(embedding, "_epoch_sums", watched)
    model, history = fit_embedding(training, labels, width=8, epochs=3, shares=4)
    assert [p[0] for p in passes] == [0, 1, 2, 3] * 3 + [-1]
    for epoch in range(3):
        assert sum(p[2] for p in passes[4 * epoch : 4 * epoch + 4]) == n_train
    assert [p[3] for p in passes if p[1]] == [n_val] * 3 and len(history) == 3
    n = label_width(labels)
    assert passes[0][4] | {"departments": None, "words": None} == {
        "words": None, "departments": None, "dense": (16, 256), "dense_bias": (256,), "classes": (n, 256), "bias": (n,)
    }


def test_the_rate_is_halved_when_the_validation_loss_does_not_fall(prepared):
    training, labels = prepared
    _, history = fit_embedding(training, labels, width=8, epochs=12, patience=12, rate=0.4)
    least, rate = float("inf"), 0.4
    for e in history:
        assert e.rate == pytest.approx(rate)
        if e.val_loss < least - 1e-4:
            least = e.val_loss
        else:
            rate /= 2
    assert rate < 0.4 and all(e.val_loss > 0 for e in history)


def test_a_pass_sends_its_weights_once(spark, monkeypatch):
    """Weights beside the broadcast ones would go with the plan of each pass, whose file is never deleted."""
    held, add_up = [], embedding.summed
    monkeypatch.setattr(embedding, "summed", lambda table, size, add: held.append(add) or add_up(table, size, add))
    table = spark.createDataFrame([([2, 3], 0, 1, 0), ([3], 1, 2, -1)], "word_ids array<int>, department_id int, label_id int, share int")
    embedding._epoch_sums(table.mapInArrow(embedding._packed, embedding._PACKED), whole_network(np.random.default_rng(6)), 0)
    cells = [c.cell_contents for c in held[0].__closure__]
    cells += [c.cell_contents for f in cells if callable(f) for c in f.__closure__ or ()]
    assert not any(isinstance(c, dict | np.ndarray) for c in cells)


def test_a_model_without_a_dense_layer_still_scores(prepared):
    training, labels = prepared
    model, _ = fit_embedding(training, labels, width=8, epochs=1)
    chance, n = np.random.default_rng(5), label_width(labels)
    old = {"words": (20000, 8), "departments": (model.departments.count(), 8), "classes": (n, 8), "bias": (n,)}
    weights = {name: chance.normal(size=shape) for name, shape in old.items()}
    made = EmbeddingModel(weights, model.words, model.departments, labels).scores(training).select("scores").collect()
    assert len(made) == 240 and all(abs(sum(r["scores"]) - 1) < 1e-9 for r in made)


def test_blocks_hold_one_share_and_sum_to_the_same_gradients(spark):
    """An epoch reads its own share and the validation part only."""
    chance = np.random.default_rng(2)
    weights = {
        "words": chance.normal(size=(20, 4)), "departments": chance.normal(size=(3, 4)),
        "classes": chance.normal(size=(5, 4)), "bias": chance.normal(size=5),
    }
    rows = []
    for i in range(40):
        words = chance.integers(2, 20, size=int(chance.integers(0, 6))).tolist()
        rows.append((words, None if i % 7 == 0 else i % 3, i % 5, i % 3 - 1))
    table = spark.createDataFrame(rows, "word_ids array<int>, department_id int, label_id int, share int").repartition(3)
    blocks = table.mapInArrow(embedding._packed, embedding._PACKED).cache()
    assert blocks.count() == blocks.select("share", F.spark_partition_id()).distinct().count()
    for share in (0, 1):
        sums, loss, n, hits, n_val = embedding._epoch_sums(blocks, weights, share)
        own = [r for r in rows if r[3] == share]
        ids = [np.array(r[0], dtype=np.int64) for r in own]
        departments = np.array([-1 if r[1] is None else r[1] for r in own])
        want, whole = gradients(weights, ids, departments, np.array([r[2] for r in own]))
        assert n == len(own) and loss == pytest.approx(whole) and n_val == 14 and 0 <= hits <= 14
        assert all(np.allclose(sums[name], want[name]) for name in weights)


def test_training_stops_keeps_the_best_and_is_repeatable(prepared, spark, tmp_path):
    training, labels = prepared
    model, history = fit_embedding(training, labels, width=8, epochs=20, patience=4)
    again, same = fit_embedding(training, labels, width=8, epochs=20, patience=4)
    assert [(e.epoch, e.val_top1) for e in same] == [(e.epoch, e.val_top1) for e in history]
    assert [e.loss for e in same] == pytest.approx([e.loss for e in history])
    top1 = [e.val_top1 for e in history]
    assert len(history) == min(20, top1.index(max(top1)) + 1 + 4) and max(top1) > 0.9
    val = training.filter("split = 'val'")
    hits = model.predict(val, k=2).agg(F.avg((F.col("pred_heading") == F.col("heading_collapsed")).cast("int"))).first()[0]
    assert hits == pytest.approx(max(top1))

    model.save(str(tmp_path / "m"))
    back = EmbeddingModel.load(spark, str(tmp_path / "m"))
    asked = spark.createDataFrame([("asked about rent", "dept-homes"), (None, None), ("exam", "never seen")], "question string, department string")
    want, got = ([r["scores"] for r in m.scores(asked).orderBy("question").collect()] for m in (model, back))
    assert want == got and all(abs(sum(s) - 1) < 1e-9 for s in got)


def test_the_embedding_takes_part_in_the_sweep(prepared):
    training, labels = prepared
    choices = {"bayes": naive_bayes(), "embedding": lambda t, n: fit_embedding(t, n, width=8, epochs=12)[0]}
    model, results = sweep(training, labels, choices)
    assert [r.name for r in results] == ["bayes", "embedding"] and results[1].top1_accuracy > 0.9
    assert model is max(results, key=lambda r: r.top1_accuracy) or model.predict(training, k=1).count() == 240


def test_a_sweep_makes_the_vocabulary_once_and_fits_logistic_models_together(prepared, monkeypatch):
    training, labels = prepared
    words = vocabulary(training.filter("split = 'train'"), "question_clean")
    counted, together = [], []
    for module in (embedding, models):
        monkeypatch.setattr(module, "vocabulary", lambda *_: counted.append(1))
    fit = models.fit_together
    monkeypatch.setattr(models, "fit_together", lambda made, rows: together.append(len(made)) or fit(made, rows))
    choices = {"weak": logistic(1e-2, 5), "embedding": lambda t, n: fit_embedding(t, n, width=8, epochs=2, words=words)[0], "strong": logistic(1e-1, 5)}
    model, results = sweep(training, labels, choices, words=words)
    assert [r.name for r in results] == list(choices) and not counted and together == [2]
    monkeypatch.undo()
    _, alone = sweep(training, labels, {"strong": logistic(1e-1, 5)})
    assert (alone[0].top1_accuracy, alone[0].top3_accuracy) == (results[2].top1_accuracy, results[2].top3_accuracy)


def test_the_switch_for_raw_text_is_saved(prepared, spark, tmp_path):
    training, labels = prepared
    model = train(training, labels, naive_bayes())
    asked = spark.createDataFrame([("Deputy A asked RENT, house!", "dept-homes", "x")], "question string, department string, question_clean string")
    raw = model.on_raw_text()
    raw.save(str(tmp_path / "raw"))
    for m, expected in ((model, "x"), (raw, asked.first()["question"]), (HeadingModel.load(spark, str(tmp_path / "raw")), asked.first()["question"])):
        assert m.scores(asked).first()["question_clean"] == expected
    assert raw.scores(asked.select("question")).count() == 1  # no cleaned column, no department


def test_plugged_in_models_in_one_pass(spark):
    def load(step):
        return lambda: lambda texts: [[len(t), step * len(t), 1] for t in texts]

    rows = spark.createDataFrame([("ab",), ("c",)], "t string")
    made = rows.select("t", plugin_scores(F.col("t"), {"one": load(1), "two": load(2)}, classes=3, key="lengths").alias("s"))
    assert sorted((r["t"], r["s"]["one"], r["s"]["two"]) for r in made.collect()) == [
        ("ab", [2, 2, 1], [2, 4, 1]), ("c", [1, 1, 1], [1, 2, 1])
    ]
    wrong = rows.select(plugin_scores(F.col("t"), load(1), classes=4))
    with pytest.raises(Exception, match="gives 3 scores for a label map of 4 classes"):
        wrong.collect()
    assert label_width(spark.createDataFrame([("a", 0), ("b", 5)], "heading string, label_id int")) == 6


def test_a_worker_loads_a_model_once():
    _LOADED.clear()
    calls = []

    def load():
        calls.append(1)
        return lambda texts: [[1.0] for _ in texts]

    assert loaded("a", load) is loaded("a", load) and len(calls) == 1
    for key in "bcde":
        loaded(key, load)
    assert len(_LOADED) == 4 and "a" not in _LOADED
    loaded(None, load)
    assert len(calls) == 6
    _LOADED.clear()
