import json
import random

import pytest
from pyspark.sql import functions as F

from headingflow.functions.text import clean_question
from headingflow.operators.canon import extract_questions
from headingflow.operators.metrics import daily_metrics, validation_metrics
from headingflow.operators.model import HeadingModel, logistic, naive_bayes, sweep, train
from headingflow.operators.upsert import read_table
from headingflow.operators.widen import widen_candidates
from headingflow.plans.daily import run_daily, run_daily_files
from headingflow.plans.scoring import evaluate_predictions, score_arrays, score_questions, score_upload
from headingflow.plans.training import prepare_training, run_metadata, run_training
from headingflow.sources.files import append_history, read_csv, read_history
from headingflow.streaming.refresh import refresh_metrics

TOPICS = {
    "housing": ["rent", "homes", "tenants", "planning"],
    "hospitals": ["beds", "nurses", "wards", "surgery"],
    "schools": ["teachers", "pupils", "classes", "exams"],
    "roads": ["traffic", "bridge", "potholes", "bypass"],
}


def corpus_rows(n=360):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        heading = rng.choice([*TOPICS, "housing", "housing"])
        words = rng.choices(TOPICS[heading], k=6) + rng.choices(["plan", "cost", "county"], k=3)
        rng.shuffle(words)
        question = f"{i}. Deputy Ann Byrne asked the Minister for State, to outline " + " ".join(words)
        rows.append((i, question, rng.choice(["north", "south", None]), heading))
    # Three rare headings and one without any.
    rows += [(n + i, "odd matter", "north", h) for i, h in enumerate(["r1", "r2", "r3", None])]
    return rows


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(corpus_rows(), "id long, question string, department string, heading string")


@pytest.fixture(scope="module")
def prepared(corpus):
    return prepare_training(corpus, "id")


@pytest.fixture(scope="module")
def model(prepared):
    return train(*prepared, logistic(1e-2, 12), num_words=60)


def test_prepared_training_table(prepared):
    training, labels = prepared
    assert sorted(r["heading"] for r in labels.collect()) == ["Other", *sorted(TOPICS)]
    assert training.count() == 364
    assert training.filter("label_id is null or split not in ('train', 'val')").isEmpty()
    assert training.filter(F.col("question_clean").contains("deputy")).isEmpty()
    assert training.filter("heading_collapsed = 'Other'").count() == 4


def test_a_cleaned_corpus_needs_no_raw_text(corpus, prepared):
    cleaned = corpus.select("id", clean_question("question").alias("question_clean"), "department", "heading")
    names = ["id", "question_clean", "department", "label_id", "split"]
    again = prepare_training(cleaned, "id")[0].select(*names)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, prepared[0].select(*names).collect()))
    with pytest.raises(ValueError, match="question"):
        prepare_training(cleaned.drop("question_clean"), "id")


def test_training_run_saves_model_record_and_report(spark, corpus, tmp_path):
    out = str(tmp_path / "run")
    choices = {"naive_bayes": naive_bayes(), "logistic": logistic(1e-2, 8)}
    model, report = run_training(corpus, "id", out, choices, num_words=60)
    run_training(corpus, "id", out, {"logistic": logistic(1e-2, 8)}, num_words=60)
    runs = spark.read.parquet(f"{out}/runs").collect()
    assert len(runs) == 2 and {r["num_words"] for r in runs} == {60}
    logistic_run = next(r for r in runs if r["classifier"] == "logistic")
    assert logistic_run["objective_history"][0] > logistic_run["objective_history"][-1]
    assert report.first()["top1_accuracy"] == pytest.approx(max(r["val_top1"] for r in runs), abs=1e-9)
    again = HeadingModel.load(spark, f"{out}/model")
    assert again.predict(corpus, k=1).count() == corpus.count()


def test_model_beats_the_largest_class(prepared, model):
    training, _ = prepared
    val = training.filter("split = 'val'")
    counts = [r["count"] for r in val.groupBy("heading_collapsed").count().collect()]
    got = validation_metrics(model.predict(val, k=3), "heading_collapsed").first()
    assert got["n"] == sum(counts)
    assert got["top1_accuracy"] > max(counts) / sum(counts) + 0.2
    assert got["top3_accuracy"] >= got["top1_accuracy"]


def test_scoring_cleans_raw_questions_like_training(corpus, prepared, model):
    training, _ = prepared
    raw = model.predict(corpus, k=2).select("id", "pred_heading", "question_clean")
    clean = model.predict(training, k=2).select("id", "pred_heading", "question_clean")
    assert sorted(map(tuple, raw.collect())) == sorted(map(tuple, clean.collect()))


def test_scores_are_probabilities_and_inputs_pass_through(corpus, model):
    scored = model.scores(corpus.withColumn("extra", F.lit(1)))
    assert scored.columns == [*corpus.columns, "extra", "question_clean", "scores"]
    for row in scored.limit(20).collect():
        assert sum(row["scores"]) == pytest.approx(1.0) and len(row["scores"]) == 5


def test_fewer_classes_than_k(corpus, model):
    assert {len(r["candidates"]) for r in model.predict(corpus, k=10).collect()} == {5}


def test_unseen_department_scores_without_a_department(spark, model):
    rows = spark.createDataFrame([("why", "east"), ("why", "far")], "question string, department string")
    first, second = (r["candidates"] for r in model.predict(rows).collect())
    assert len(first) == 5 and first == second


def test_save_and_load(spark, corpus, model, tmp_path):
    model.save(str(tmp_path / "model"))
    again = HeadingModel.load(spark, str(tmp_path / "model"))
    columns = ["id", "pred_heading", "pred_confidence"]
    before = sorted(map(tuple, model.predict(corpus).select(*columns).collect()))
    after = sorted(map(tuple, again.predict(corpus).select(*columns).collect()))
    assert before == after


def test_sweep_keeps_the_best(prepared):
    choices = {"flat": logistic(1e3, 3), "bayes": naive_bayes(), "logistic": logistic(1e-2, 8)}
    best, results = sweep(*prepared, choices, num_words=60)
    assert [r.name for r in results] == list(choices)
    top = max(r.top1_accuracy for r in results)
    training, _ = prepared
    again = validation_metrics(best.predict(training.filter("split = 'val'"), k=3), "heading_collapsed")
    assert again.first()["top1_accuracy"] == pytest.approx(top)
    assert top > results[0].top1_accuracy


def test_run_metadata(prepared):
    row = run_metadata(prepared[0], epochs=12).first()
    assert (row["n_headings"], row["n_departments"], row["epochs"]) == (5, 3, 12)
    assert row["train_rows"] + row["val_rows"] == 364


def documents():
    texts = []
    for i, question, department, heading in corpus_rows():
        day = f"2026-01-{13 + i % 5}"
        item = {"question": {"showAs": question, "date": day, "to": {"showAs": department or "south"}}}
        item["question"]["debateSection"] = {"showAs": heading or "none"}
        texts.append(json.dumps({"results": [item, {"heading": "junk"}]}))
    return texts


def first_letter_model(df):
    """A stand-in for a model: three candidates from the words of the question."""
    names = F.array(*[F.when(F.col("question").contains(w[0]), F.lit(t)) for t, w in TOPICS.items()])
    found = F.filter(F.concat(names, F.array(F.lit("roads"))), lambda n: n.isNotNull())
    candidates = F.transform(
        found, lambda n, i: F.struct((i + 1).alias("rank"), n.alias("heading"), (F.lit(0.9) / (i + 1)).alias("conf"))
    )
    return df.withColumn("candidates", candidates).select(
        *df.columns,
        F.get("candidates", F.lit(0))["heading"].alias("pred_heading"),
        F.get("candidates", F.lit(0))["conf"].alias("pred_confidence"),
        "candidates",
    )


def table(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r["model"], str(r["date"])))


def nearly(rows):
    """Means of doubles depend on the order of the sum."""
    return [{k: pytest.approx(v) if isinstance(v, float) else v for k, v in r.items()} for r in rows]


@pytest.fixture(scope="module")
def models():
    return {"words": first_letter_model, "roads": lambda df: first_letter_model(df.withColumn("question", F.lit("")))}


@pytest.fixture(scope="module")
def expected(spark, models):
    rows = extract_questions(spark.createDataFrame([(t,) for t in documents()], "value string"))
    parts = [m(rows).withColumn("model", F.lit(n)) for n, m in models.items()]
    both = parts[0].unionByName(parts[1])
    made = daily_metrics(both, ks=(1, 2), keys=("model", "date"))
    return table(made.withColumn("date", F.col("date").cast("string")))


def test_daily_job(spark, models, expected, tmp_path):
    source = spark.createDataFrame([(t,) for t in documents()], "value string")
    path = str(tmp_path / "metrics")
    for _ in range(2):
        run_daily(source, models, path, predictions_path=str(tmp_path / "predictions"), ks=(1, 2))
        assert table(read_table(spark, path, ("model", "date"))) == nearly(expected)
    assert spark.read.parquet(str(tmp_path / "predictions")).count() == 2 * 364
    with pytest.raises(ValueError, match="No rows"):
        run_daily(source.limit(0), models, path)


def test_stream_equals_the_batch_job(spark, models, expected, tmp_path):
    landing, texts = tmp_path / "landing", documents()
    landing.mkdir()
    args = [str(tmp_path / n) for n in ("predictions", "metrics", "checkpoint")]
    # Every day arrives in pieces; one file holds nothing usable.
    for part, lines in enumerate([texts[:100], ['{"items": [17]}'], texts[100:101], texts[101:]]):
        (landing / f"{part}.txt").write_text("\n".join(lines))
        query = refresh_metrics(spark, str(landing), models, *args, ks=(1, 2))
        query.awaitTermination(120)
        assert query.exception() is None
    assert table(read_table(spark, args[1], ("model", "date"))) == nearly(expected)


def test_trained_model_in_the_daily_job(spark, model, tmp_path):
    source = spark.createDataFrame([(t,) for t in documents()], "value string")
    made = run_daily(source, {"logistic": lambda df: model.predict(df, k=5)}, str(tmp_path / "m"), ks=(1, 3), max_k=5)
    assert made.agg(F.sum("n")).first()[0] == 364
    assert made.agg(F.sum("n_top1")).first()[0] > 180


def test_score_upload(spark, model, tmp_path):
    rows = [{"question": f"to outline {w[0]} and {w[1]}", "department": "north", "heading": t} for t, w in TOPICS.items()]
    source = tmp_path / "asked.json"
    source.write_text(json.dumps({"data": rows}))
    wide = score_upload(spark, str(source), model, str(tmp_path / "out"), k=2)
    assert wide.columns == ["question", "department", "heading", "pred_heading", "pred_confidence",
                            "alt_heading_1", "alt_conf_1", "alt_heading_2", "alt_conf_2"]
    back = read_csv(spark, str(tmp_path / "out"), wide.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


def test_score_questions(spark, corpus, model):
    departments = corpus.select(F.coalesce("department", F.lit("")).alias("department")).distinct()
    scored = score_questions(corpus, model, departments, k=4)
    assert scored.filter("pred_heading = 'Other'").isEmpty()
    assert scored.filter("needs_review <> (pred_confidence < 0.25)").isEmpty()
    assert "alt_heading_3" in scored.columns and "alt_heading_4" not in scored.columns
    with pytest.raises(ValueError, match=r"Unseen department: \['east'\]"):
        score_questions(corpus.withColumn("department", F.lit("east")), model, departments)


def test_score_arrays(spark, model, tmp_path):
    batches = spark.createDataFrame(
        [(1, "[0, 1]", json.dumps(["rent homes", "beds nurses"])), (2, "[1]", json.dumps(["exams pupils"]))],
        "batch long, d string, q string",
    )
    departments = spark.createDataFrame([(0, "north"), (1, "south")], "department_id int, department string")
    path = str(tmp_path / "predicted")
    score_arrays(batches, "d", "q", "batch", departments, model, path, "2026-02-19")
    back = spark.read.schema("question string, predicted_heading string, run_date string").json(path)
    assert {r["question"] for r in back.collect()} == {"rent homes", "beds nurses", "exams pupils"}
    assert {r["run_date"] for r in back.collect()} == {"2026-02-19"}


def test_evaluation_of_wide_and_gathered_predictions(corpus, model):
    scored = model.predict(corpus, k=5).cache()
    gathered = evaluate_predictions(scored, "id")
    wide = evaluate_predictions(widen_candidates(scored, 5), "id")
    assert gathered.keys() == wide.keys()
    for name in gathered:
        same = set(gathered[name].columns) & set(wide[name].columns)
        assert same == set(wide[name].columns)
        left, right = (sorted(map(tuple, t[name].select(*sorted(same)).collect()), key=repr) for t in (gathered, wide))
        assert left == right
    with pytest.raises(ValueError, match="No rows"):
        evaluate_predictions(scored.limit(0), "id")
    with pytest.raises(ValueError, match="pred_heading"):
        evaluate_predictions(corpus, "id")


def test_daily_job_over_huge_documents_with_faults(spark, models, expected, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    items = [i for text in documents() for i in items_of(json.loads(text))]
    # One document holds all items, one more only what cannot be read.
    (landing / "all.json").write_text(json.dumps({"data": items}))
    (landing / "faults.json").write_text("[{'x'}, {\"question\": ]")
    path = str(tmp_path / "metrics")
    metrics, rejects = run_daily_files(spark, str(landing), models, path, str(tmp_path / "rejects"), ks=(1, 2))
    assert table(read_table(spark, path, ("model", "date"))) == nearly(expected)
    assert rejects.count() > 0 and {r.document.rsplit("/", 1)[1] for r in rejects.collect()} == {"faults.json"}


def items_of(document):
    if isinstance(document, list):
        return document
    return next(document[k] for k in ("items", "results", "data", "pqs", "questions") if isinstance(document.get(k), list))


def test_history_of_runs_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "history")
    append_history(spark.createDataFrame([(0, "loss", 1.5)], "step int, name string, value double"), path, "first")
    more = spark.createDataFrame([(0, "loss", 1.0, "nats")], "step int, name string, value double, unit string")
    append_history(more, path, "second")
    got = read_history(spark, path).select("run_id", "step", "name", "value", "unit").collect()
    assert sorted(map(tuple, got)) == [("first", 0, "loss", 1.5, None), ("second", 0, "loss", 1.0, "nats")]
    with pytest.raises(ValueError, match="value"):
        append_history(more.drop("value"), path, "third")
