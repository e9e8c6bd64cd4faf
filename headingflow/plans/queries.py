"""The registered queries. Each reads whole tables and returns plain columns.

Days are shown as text and rates are rounded to six digits, so that results
can be compared across engines.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headingflow.functions.candidates import (
    OTHER,
    hit_within,
    needs_review,
    rank_classes,
    reported_hit,
    softmax,
    truth_rank,
)
from headingflow.functions.text import (
    clean_question,
    model_input,
    normalise_spaces,
    quoted,
    word_count,
)
from headingflow.functions.values import number, parse_day
from headingflow.operators import concentration, holdout, labels, metrics
from headingflow.operators.canon import extract_questions, zip_arrays
from headingflow.operators.guards import unseen_values, with_default
from headingflow.operators.embedding import fit_embedding
from headingflow.operators.model import (
    label_width,
    logistic,
    naive_bayes,
    plugin_scores,
    predict_from_scores,
    sweep,
    train,
)
from headingflow.operators.split import split_rows
from headingflow.operators.upsert import read_table, upsert, upsert_table
from headingflow.operators.vocabulary import encode_sequences, vocabulary
from headingflow.operators.widen import alternate_columns, top_k_rows, widen_candidates
from headingflow.plans import derived
from headingflow.plans.training import prepare_training, run_metadata
from headingflow.sources.files import append_history, read_csv, read_history, read_upload, write_csv, write_dated
from headingflow.sources.large_csv import read_csv_ranges
from headingflow.sources.large_json import read_questions
from headingflow.sources.shared import materialise, new_path

Query = Callable[[SparkSession, str], DataFrame]

SECOND_MODEL_TURN = 7
RUN_DATE = "2026-02-19"
PREVIEW_ROWS = 10
KNOWN_DAYS = 3
WIDE_COUNT = 60
BALANCE = 0.01
HISTORY_EPOCHS, HISTORY_PATIENCE = 12, 3


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, days to text."""
    shown = {"double": "round({0}, 6) as {0}", "date": "string({0}) as {0}"}
    return df.selectExpr(*[shown.get(kind, "{0}").format(quoted(name)) for name, kind in df.dtypes])


def known_headings(counts: DataFrame) -> DataFrame:
    """Headings that are not rare, and the collecting one."""
    kept = counts.filter(F.col("n") >= labels.MIN_HEADING_COUNT).select("heading")
    return kept.unionByName(counts.sparkSession.range(1).select(F.lit(OTHER).alias("heading")))


def collapsed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with rare headings collapsed in the prediction and the truth."""
    made = derived.predictions(spark, sf_dir)
    counts = labels.heading_counts(made)
    made = labels.collapse_rare(
        made, "pred_heading", "pred_heading", counts=counts.withColumnRenamed("heading", "pred_heading")
    )
    return labels.collapse_rare(made, "heading", "heading", counts=counts)


# Metrics


def daily_metrics(spark, sf_dir):
    return rounded(metrics.daily_metrics(derived.predictions(spark, sf_dir)))


def daily_top1(spark, sf_dir):
    made = derived.predictions(spark, sf_dir)
    known = known_headings(labels.heading_counts(made))
    return rounded(metrics.daily_top1(labels.collapse_unknown(made, known)))


def headline_metrics(spark, sf_dir):
    made = derived.predictions(spark, sf_dir)
    known = known_headings(labels.heading_counts(made))
    return rounded(metrics.headline(labels.collapse_unknown(made, known), collapsed="heading_eval"))


def multi_model_metrics(spark, sf_dir):
    first = derived.predictions(spark, sf_dir).withColumn("model", F.lit("first"))
    second = derived.predictions(spark, sf_dir, SECOND_MODEL_TURN).withColumn("model", F.lit("second"))
    return rounded(metrics.daily_metrics(first.unionByName(second), keys=("model", "date")))


def upsert_daily(spark, sf_dir):
    made = derived.predictions(spark, sf_dir)
    old = metrics.daily_top1(made.filter(F.col("day_no") < 20), "heading")
    old = old.withColumn("topk", F.col("n") + 1)
    new = metrics.daily_metrics(made.filter(F.col("day_no") >= 15), ks=(1, 4), thresholds=())
    return rounded(upsert(old, new))


def upsert_partitions(spark, sf_dir):
    made = derived.predictions(spark, sf_dir)
    path = new_path(spark, "upserted")
    upsert_table(metrics.daily_top1(made.filter(F.col("day_no") < 20), "heading"), path)
    upsert_table(metrics.daily_top1(made.filter(F.col("day_no") >= 15), "heading"), path)
    return rounded(read_table(spark, path))


def holdout_report(spark, sf_dir):
    return rounded(holdout.holdout_report(collapsed_predictions(spark, sf_dir)))


def review_sweep(spark, sf_dir):
    return rounded(holdout.review_sweep(derived.with_gaps(derived.predictions(spark, sf_dir))))


def department_summary(spark, sf_dir):
    return rounded(holdout.department_summary(derived.with_gaps(derived.predictions(spark, sf_dir))))


def error_sample(spark, sf_dir):
    wide = widen_candidates(derived.with_gaps(derived.predictions(spark, sf_dir)), 10, shown=3)
    keep = ["question", "department", "heading", "pred_heading", "pred_confidence", *alternate_columns(3)]
    return rounded(holdout.error_sample(wide, "pq_id", keep))


# Text


def clean_questions(spark, sf_dir):
    asked = derived.spread_questions(spark, sf_dir)
    return asked.select("pq_id", clean_question("question").alias("question_clean"))


def clean_preview(spark, sf_dir):
    asked = derived.questions(spark, sf_dir).filter(F.col("question").isNotNull())
    first = asked.orderBy("pq_id").limit(PREVIEW_ROWS)
    return first.select("pq_id", "question", clean_question("question").alias("question_clean"))


def normalise_ws(spark, sf_dir):
    asked = derived.spread_questions(spark, sf_dir)
    return asked.select("pq_id", normalise_spaces(F.col("question")).alias("question_ws"))


def model_input_text(spark, sf_dir):
    asked = derived.spread_questions(spark, sf_dir)
    cleaned = clean_question("question")
    return asked.select(
        "pq_id",
        model_input(F.col("department"), cleaned, trim=True).alias("text_clean"),
        model_input(F.col("department"), F.col("question")).alias("text_raw"),
    )


def text_length_stats(spark, sf_dir):
    asked = derived.spread_questions(spark, sf_dir).select("question")
    lengths = {
        "raw": word_count(F.col("question")),
        "clean": word_count(clean_question("question")),
    }
    return rounded(metrics.text_length_stats(asked, lengths))


def optional_columns(spark, sf_dir):
    asked = derived.spread_questions(spark, sf_dir).select("pq_id", "question")
    whole = with_default(asked, "department", F.lit(""))
    whole = with_default(whole, "question_clean", clean_question("question"))
    return whole.select("pq_id", "department", "question_clean")


# Sources and sinks


def canon_extract(spark, sf_dir):
    rows = extract_questions(derived.canon_documents(spark, sf_dir))
    return rounded(rows.select("question", "heading", "department", "date"))


def canon_large(spark, sf_dir):
    path = new_path(spark, "documents")
    derived.write_huge_documents(derived.questions_as_items(spark, sf_dir), path)
    rows, _ = read_questions(spark, path)
    return rounded(rows.select("question", "heading", "department", "date"))


def canon_rejects(spark, sf_dir):
    path = new_path(spark, "documents")
    derived.write_huge_documents(derived.faulty_items(spark, sf_dir), path)
    rows, rejects = read_questions(spark, path)
    read = rows.groupBy(F.lit("read").alias("outcome"), F.col("heading").alias("detail")).agg(F.count(F.lit(1)).alias("n"))
    reason = F.substring_index("reason", ":", 1)
    lost = rejects.groupBy(F.lit("rejected").alias("outcome"), reason.alias("detail")).agg(F.count(F.lit(1)).alias("n"))
    return read.unionByName(lost)


def parse_dates(spark, sf_dir):
    raw = derived.raw_days(spark, sf_dir)
    return rounded(raw.select("pq_id", "raw", parse_day("raw").alias("day")))


def coerce_confidence(spark, sf_dir):
    raw = derived.with_gaps(derived.questions(spark, sf_dir))
    conf = F.col("pred_confidence")
    return raw.select(
        "pq_id",
        number(conf, default=0.0).alias("conf_metrics"),
        number(conf).alias("conf_report"),
        number(conf, default=-1.0).alias("conf_sample"),
    )


def parallel_arrays(spark, sf_dir):
    both = derived.parallel_documents(spark, sf_dir)
    rows = zip_arrays(both, "departments_json", "questions_json", "pq_id")
    return rows.withColumn("position", F.col("position").cast("long"))


def csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "questions") + ".csv"
    asked = derived.questions(spark, sf_dir).select("pq_id", "question", "department", "heading")
    write_csv(asked, path)
    return read_csv(spark, path, "pq_id long, question string, department string, heading string")


def csv_split(spark, sf_dir):
    path = new_path(spark, "questions") + ".csv"
    asked = derived.questions(spark, sf_dir).select("pq_id", "question", "department", "heading")
    write_csv(asked, path)
    return read_csv_ranges(spark, path, "pq_id long, question string, department string, heading string")


def dated_sink(spark, sf_dir):
    path = new_path(spark, "predicted")
    made = derived.predictions(spark, sf_dir).select("pq_id", "question", F.col("pred_heading"))
    write_dated(made, path, RUN_DATE)
    schema = "pq_id long, question string, pred_heading string, run_date string"
    return spark.read.schema(schema).json(path)


def load_by_suffix(spark, sf_dir):
    asked = derived.questions(spark, sf_dir).select("question", "department", "heading")
    csv_path = new_path(spark, "upload") + ".csv"
    json_path = new_path(spark, "upload") + ".json"
    write_csv(asked, csv_path)
    one_each = F.to_json(F.struct(F.array(F.struct(*asked.columns)).alias("data")))
    asked.select(one_each.alias("value")).write.text(json_path)
    parts = [
        read_upload(spark, csv_path).withColumn("suffix", F.lit("csv")),
        read_upload(spark, json_path, per_line=True).withColumn("suffix", F.lit("json")),
    ]
    return reduce(DataFrame.unionByName, parts)


# Labels


def label_encode(spark, sf_dir):
    asked = derived.questions(spark, sf_dir).select("pq_id", "heading", "department")
    headings = labels.dictionary(asked, "heading", "label_id")
    departments = labels.dictionary(asked, "department", "department_id")
    coded = labels.encode(asked, headings, "heading", "label_id")
    return labels.encode(coded, departments, "department", "department_id")


def decode_labels(spark, sf_dir):
    asked = derived.questions(spark, sf_dir)
    known = derived.labels(asked)
    ids = asked.select("pq_id", (F.col("pq_id") % 100).cast("int").alias("class_id"))
    plain = labels.decode(ids, known, "class_id", "heading", "heading", known_id="label_id")
    return labels.decode(
        plain, known, "class_id", "heading", "heading_marked", "__UNK_{}__", known_id="label_id"
    )


def truth_collapse(spark, sf_dir):
    asked = derived.questions(spark, sf_dir).select("pq_id", "heading")
    return labels.collapse_unknown(asked, known_headings(labels.heading_counts(asked)))


def unseen_departments(spark, sf_dir):
    # Known from the first days, checked for all; here a department is a
    # language and source, so that some are new.
    asked = derived.questions(spark, sf_dir).select("day_no", F.col("heading").alias("department"))
    return unseen_values(asked, asked.filter(F.col("day_no") < KNOWN_DAYS), "department")


def rare_collapse(spark, sf_dir):
    asked = derived.questions(spark, sf_dir).select("pq_id", "heading")
    return labels.collapse_rare(asked).select("pq_id", "heading_collapsed")


def rare_collapse_wide(spark, sf_dir):
    # At this bound some headings are rare in a large table too.
    asked = derived.questions(spark, sf_dir).select("pq_id", "heading")
    return labels.collapse_rare(asked, min_count=WIDE_COUNT).select("pq_id", "heading_collapsed")


def rare_collapse_summary(spark, sf_dir):
    return labels.collapse_summary(derived.questions(spark, sf_dir).select("heading"))


def heading_distribution(spark, sf_dir):
    return rounded(concentration.heading_distribution(derived.questions(spark, sf_dir)))


def coverage_thresholds(spark, sf_dir):
    return concentration.coverage_thresholds(derived.questions(spark, sf_dir))


# Candidates


def topk_long(spark, sf_dir):
    asked = derived.questions(spark, sf_dir).select("pq_id", "heading")
    known = derived.labels(asked)
    scores = derived.ranked_questions(asked, known).select("pq_id", F.inline("ranked"))
    best = top_k_rows(scores.drop("rank"), "pq_id", "class_id", "conf", 3)
    decoded = labels.decode(best, known, "class_id", "heading", "heading", known_id="label_id")
    return rounded(decoded.select("pq_id", F.col("rank").cast("long").alias("rank"), "heading", "conf"))


def topk_inrow(spark, sf_dir):
    return best_in_row(spark, sf_dir, lambda known: known)


def decode_sparse(spark, sf_dir):
    # A label map with gaps: the ids it lacks are shown themselves.
    return best_in_row(spark, sf_dir, lambda known: known.filter(F.col("label_id") % 3 != 0))


def best_in_row(spark, sf_dir, label_map):
    """The best three classes of whole score vectors, ranked and decoded inside the row."""
    asked = derived.questions(spark, sf_dir).select("pq_id", "heading")
    known = derived.labels(asked)
    vectors = derived.score_vectors(derived.ranked_questions(asked, known), known)
    ranked = vectors.withColumn("ranked", rank_classes(F.col("scores"), 3))
    decoded = labels.decode_candidates(ranked, "ranked", label_map(known))
    rows = decoded.select("pq_id", F.inline("candidates"))
    return rounded(rows.select("pq_id", F.col("rank").cast("long").alias("rank"), "heading", "conf"))


def topk_hit(spark, sf_dir):
    made = derived.predictions(spark, sf_dir)
    rank = truth_rank(F.col("candidates"), F.col("heading"))
    ranked = made.select("pq_id", "heading", "pred_heading", "candidates", rank.alias("truth_rank"))
    report = reported_hit(F.col("heading"), F.col("pred_heading"), F.col("candidates"))
    return ranked.select(
        "pq_id",
        hit_within(F.col("truth_rank"), 4).alias("top4"),
        hit_within(F.col("truth_rank"), 10).alias("top10"),
        report.alias("report_hit"),
    )


def softmax_scores(spark, sf_dir):
    made = derived.predictions(spark, sf_dir)
    logits = F.transform("candidates", lambda c: c["conf"] * 10)
    scored = made.select("pq_id", F.posexplode(softmax(logits)).alias("place", "probability"))
    return rounded(scored.select("pq_id", (F.col("place") + 1).cast("long").alias("rank"), "probability"))


def never_other(spark, sf_dir):
    asked = derived.questions(spark, sf_dir).select("pq_id", "heading")
    known = derived.labels(asked)
    counts = labels.heading_counts(asked)
    collapsed = labels.collapse_rare(known, out="heading", counts=counts)
    vectors = derived.score_vectors(derived.ranked_questions(asked, known), known)
    picked = predict_from_scores(vectors, collapsed, k=1, never_other=True)
    return rounded(picked.select("pq_id", "pred_heading", "pred_confidence"))


def wide_candidates(spark, sf_dir):
    made = derived.predictions(spark, sf_dir).select("pq_id", "pred_heading", "pred_confidence", "candidates")
    return rounded(widen_candidates(made, 10))


def wide_alternates(spark, sf_dir):
    made = derived.predictions(spark, sf_dir).select("pq_id", "pred_heading", "pred_confidence", "candidates")
    return rounded(widen_candidates(made, 4, skip_first=True))


def review_flag(spark, sf_dir):
    made = derived.predictions(spark, sf_dir)
    return made.select("pq_id", needs_review(F.col("pred_confidence")).alias("needs_review"))


def review_count(spark, sf_dir):
    made = derived.predictions(spark, sf_dir)
    return made.agg(F.count_if(needs_review(F.col("pred_confidence"))).alias("flagged"), F.count(F.lit(1)).alias("n"))


# Feature preparation and models


def word_vocabulary(spark, sf_dir):
    asked = derived.spread_questions(spark, sf_dir)
    cleaned = asked.select(clean_question("question").alias("question_clean"))
    return vocabulary(cleaned, "question_clean")


def word_sequences(spark, sf_dir):
    # Two passes read the cleaned texts: cleaning again would cost more than the copy.
    cleaned = materialise(clean_questions(spark, sf_dir), "cleaned")
    coded = encode_sequences(cleaned, vocabulary(cleaned, "question_clean"), "question_clean")
    return coded.select("pq_id", F.array_join("word_ids", ",").alias("word_ids"))


def stratified_split(spark, sf_dir):
    asked = derived.questions(spark, sf_dir).select("pq_id", "heading")
    return split_rows(asked, "pq_id")


def unstratified_split(spark, sf_dir):
    asked = derived.questions(spark, sf_dir).select("pq_id")
    return split_rows(asked, "pq_id", label=None)


def run_record(spark, sf_dir):
    asked = derived.questions(spark, sf_dir).select("pq_id", "department", "heading")
    split = split_rows(labels.collapse_rare(asked), "pq_id", "heading_collapsed")
    return run_metadata(split)


def train_score_baseline(spark, sf_dir):
    training, known = prepare_training(derived.spread_questions(spark, sf_dir), "pq_id")
    model = train(training, known, naive_bayes())
    scored = model.predict(training, k=3)
    return rounded(
        metrics.daily_top1(
            scored.withColumn("date", F.col("split")), "heading_collapsed"
        ).withColumnRenamed("date", "split")
    )


def score_topk(spark, sf_dir):
    training, known = prepare_training(derived.spread_questions(spark, sf_dir), "pq_id")
    model = train(training, known, logistic())
    # The training table has the cleaned text of every question.
    cleaned = training.select("pq_id", "question_clean", "department")
    scored = model.predict(cleaned, k=4, never_other=True)
    flagged = scored.withColumn("needs_review", needs_review(F.col("pred_confidence")))
    return rounded(widen_candidates(flagged.drop("question_clean"), 4, shown=3))


def score_raw(spark, sf_dir):
    """A model of cleaned questions that scores raw ones, as the daily job may."""
    asked = derived.spread_questions(spark, sf_dir)
    training, known = prepare_training(asked, "pq_id")
    model = train(training, known, naive_bayes()).on_raw_text()
    scored = model.predict(asked.select("pq_id", "question", "department"), k=1)
    truth = training.select("pq_id", "heading_collapsed", F.col("split").alias("date"))
    measured = metrics.daily_top1(scored.join(truth, "pq_id"), "heading_collapsed")
    return rounded(measured.withColumnRenamed("date", "split"))


def logistic_balance(spark, sf_dir):
    """A fit is at its optimum in the intercepts: the chances of a class add up to its rows."""
    training, known = prepare_training(derived.spread_questions(spark, sf_dir), "pq_id")
    model = train(training, known, logistic())
    rows = model.scores(training.filter(F.col("split") == "train")).select("label_id", "scores")
    chances = rows.select("label_id", F.posexplode("scores").alias("class_id", "chance"))
    per_class = chances.groupBy("class_id").agg(
        F.sum("chance").alias("_expected"),
        F.count_if(F.col("class_id") == F.col("label_id")).alias("n_train"),
        F.count(F.lit(1)).alias("_rows"),
    )
    named = per_class.join(known, F.col("class_id") == F.col("label_id"))
    off = F.abs(F.col("_expected") - F.col("n_train")) / F.col("_rows")
    return named.select("heading", "n_train", (off < BALANCE).alias("balanced"))


def training_history(spark, sf_dir):
    """What must hold of the epochs of any training, and of the model it keeps."""
    training, known = prepare_training(derived.spread_questions(spark, sf_dir), "pq_id")
    model, epochs = fit_embedding(training, known, epochs=HISTORY_EPOCHS, patience=HISTORY_PATIENCE)
    top1 = [e.val_top1 for e in epochs]
    first_best = top1.index(max(top1)) + 1
    val = model.predict(training.filter(F.col("split") == "val"), k=1)
    kept = metrics.validation_metrics(val, "heading_collapsed").first()
    checks = {
        "epochs are numbered from 1": [e.epoch for e in epochs] == list(range(1, len(epochs) + 1)),
        "training ends at the limit or out of patience": len(epochs) in (HISTORY_EPOCHS, first_best + HISTORY_PATIENCE),
        "the loss falls": epochs[-1].loss < epochs[0].loss,
        "the model is that of the first best epoch": abs(kept["top1_accuracy"] - max(top1)) < 1e-9,
    }
    rows = [(name, bool(holds), int(kept["n"])) for name, holds in checks.items()]
    return spark.createDataFrame(rows, "what string, holds boolean, n_val long")


def run_history(spark, sf_dir):
    """Two runs appended to one history, the second with a column that the first had not."""
    path = new_path(spark, "history")
    counts = labels.heading_counts(derived.questions(spark, sf_dir))
    for run, least in (("first", (2, 8)), ("second", (8, 16, 60))):
        steps = []
        for step, n in enumerate(least):
            summary = labels.collapse_summary(counts, min_count=n, counts=counts)
            pairs = [F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in summary.columns]
            values = summary.select(F.inline(F.array(*pairs)))
            made = values.select(F.lit(step).alias("step"), "name", "value")
            steps.append(made if run == "first" else made.withColumn("least", F.lit(n)))
        append_history(reduce(DataFrame.unionByName, steps), path, run)
    return read_history(spark, path).select("run_id", "step", "name", "value", "least")


def plugged_in(spark, sf_dir):
    """Two scorers of no framework, each loaded once by a worker, in one pass over the questions."""
    asked = derived.spread_questions(spark, sf_dir).select("pq_id", "question", "heading")
    known = derived.labels(asked)
    n = label_width(known)

    def by_length(step: int, modulus: int):
        def load():
            def score(texts):
                return [[(len(t) * step + c * 17) % modulus / modulus for c in range(n)] for t in texts]

            return score

        return load

    models = {"first": by_length(31, 101), "second": by_length(7, 97)}
    scored = asked.withColumn("_scores", plugin_scores(F.col("question"), models, classes=n, key="by-length"))
    scored = materialise(scored.select("pq_id", "_scores.*"), "plugged-in")
    parts = []
    for name in models:
        made = predict_from_scores(scored.select("pq_id", F.col(name).alias("scores")), known, k=3)
        rows = made.select(F.lit(name).alias("model"), "pq_id", F.inline("candidates"))
        parts.append(rows.withColumn("rank", F.col("rank").cast("long")))
    return rounded(reduce(DataFrame.unionByName, parts))


def validation_metrics(spark, sf_dir):
    training, known = prepare_training(derived.spread_questions(spark, sf_dir), "pq_id")
    model = train(training, known, naive_bayes())
    scored = model.predict(training.filter(F.col("split") == "val"), k=3)
    return rounded(metrics.validation_metrics(scored, "heading_collapsed"))


def model_sweep(spark, sf_dir):
    training, known = prepare_training(derived.spread_questions(spark, sf_dir), "pq_id")
    words = vocabulary(training.filter(F.col("split") == "train"), "question_clean")
    choices = {
        "naive_bayes": naive_bayes(),
        "logistic_1e-2": logistic(1e-2),
        "logistic_1e-1": logistic(1e-1),
        "embedding": lambda table, names: fit_embedding(table, names, words=words)[0],
    }
    # One row per choice, measured on the whole validation part.
    _, results = sweep(training, known, choices, words=words)
    measured = spark.createDataFrame(
        [(r.name, r.n, r.top1_accuracy, r.top3_accuracy) for r in results],
        "choice string, n long, top1_accuracy double, top3_accuracy double",
    )
    return rounded(measured)


QUERIES: dict[str, Query] = {
    "daily_metrics": daily_metrics,
    "daily_top1": daily_top1,
    "headline_metrics": headline_metrics,
    "multi_model_metrics": multi_model_metrics,
    "upsert_daily": upsert_daily,
    "upsert_partitions": upsert_partitions,
    "holdout_report": holdout_report,
    "review_sweep": review_sweep,
    "department_summary": department_summary,
    "error_sample": error_sample,
    "clean_question": clean_questions,
    "clean_preview": clean_preview,
    "normalise_ws": normalise_ws,
    "model_input_text": model_input_text,
    "text_length_stats": text_length_stats,
    "optional_columns": optional_columns,
    "canon_extract": canon_extract,
    "canon_large": canon_large,
    "canon_rejects": canon_rejects,
    "parse_dates": parse_dates,
    "coerce_confidence": coerce_confidence,
    "parallel_arrays": parallel_arrays,
    "csv_roundtrip": csv_roundtrip,
    "csv_split": csv_split,
    "dated_sink": dated_sink,
    "load_by_suffix": load_by_suffix,
    "label_encode": label_encode,
    "decode_labels": decode_labels,
    "truth_collapse": truth_collapse,
    "unseen_departments": unseen_departments,
    "rare_collapse": rare_collapse,
    "rare_collapse_wide": rare_collapse_wide,
    "rare_collapse_summary": rare_collapse_summary,
    "heading_distribution": heading_distribution,
    "coverage_thresholds": coverage_thresholds,
    "topk_long": topk_long,
    "topk_inrow": topk_inrow,
    "decode_sparse": decode_sparse,
    "topk_hit": topk_hit,
    "softmax": softmax_scores,
    "never_other": never_other,
    "widen_candidates": wide_candidates,
    "widen_alternates": wide_alternates,
    "review_flag": review_flag,
    "review_count": review_count,
    "vocabulary": word_vocabulary,
    "encode_sequences": word_sequences,
    "stratified_split": stratified_split,
    "unstratified_split": unstratified_split,
    "run_metadata": run_record,
    "train_score_baseline": train_score_baseline,
    "score_topk": score_topk,
    "validation_metrics": validation_metrics,
    "score_raw": score_raw,
    "logistic_balance": logistic_balance,
    "training_history": training_history,
    "run_history": run_history,
    "plugin_scores": plugged_in,
    "model_sweep": model_sweep,
}
