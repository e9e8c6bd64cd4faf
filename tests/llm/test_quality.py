import random
import re
from collections import Counter

import numpy as np
import pytest

from headingflow.llm import co_training, weak_rules
from headingflow.llm.co_training import co_train, fit_quality, score_quality
from headingflow.llm.labelled import labelled_sample
from headingflow.llm.queries import op1_quality_classifier, op2_quality_rules
from headingflow.llm.weak_rules import RULES, accuracies, fit_rules, judge_quality, text_statistics

WORD = r"[^\x20\x09-\x0D]+"


def base(text):
    words = re.findall(WORD, text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {
        i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)
    }
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    n, repeated = len(words), len(covered)
    failed = n < 50 or 100 * repeated > 50 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated, failed


def shown(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_base_of_edge_cases(edge_docs, edge_rows):
    found = judge_quality(edge_docs).collect()
    assert Counter((r.doc_id, *shown(r)) for r in found) == Counter((r[0], *base(r[1])) for r in edge_rows)
    assert not any(r.kept for r in found if r.base_failed)


def test_repeats_equal_brute_force(spark):
    chance = random.Random(1)
    texts = [" ".join(chance.choice("abcdef") for _ in range(chance.randint(0, 60))) for _ in range(150)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["_id"]: r.n_repeat_words for r in text_statistics(rows).collect()}
    assert found == {i: base(t)[4] for i, t in enumerate(texts)}


def test_empty_table_of_rules(no_docs):
    assert judge_quality(no_docs).collect() == []


def test_rules_over_documents(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    labels = dict(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").collect())
    found = {r.doc_id: r for r in op2_quality_rules(spark, sf_dir).collect()}
    assert {k: shown(r) for k, r in found.items()} == {k: base(t) for k, t in texts.items()}
    judged = [k for k in labels if not found[k].base_failed]
    right = sum(found[k].kept == (labels[k] == 1) for k in judged)
    assert right >= 0.95 * len(judged)


def test_estimates_find_the_worse_rule(spark):
    """Votes drawn from known accuracies: the estimates order the rules, and the posterior beats a majority."""
    chance = random.Random(3)
    names = [r.name for r in RULES]
    truth = {n: 0.95 - 0.05 * i for i, n in enumerate(names)}
    rows = []
    for _ in range(4000):
        good = chance.random() < 0.7
        votes = [
            None if chance.random() < 0.2 else int(good if chance.random() < truth[n] else not good) for n in names
        ]
        rows.append(tuple(votes))
    schema = ", ".join(f"{n} int" for n in names)
    model = fit_rules(spark.createDataFrame(rows, schema), iterations=60)
    found = accuracies(model)
    assert abs(model[0] - 0.7) < 0.05
    assert all(abs(found[n] - truth[n]) < 0.06 for n in names)


def test_numbers_of_odd_texts():
    for text in ("", " ", "\n\n", "a", "x" * 10_000, "\x00", "😀 😀"):
        assert len(co_training.content_numbers(text)) == len(co_training.content_numbers("a b"))
        assert len(co_training.page_numbers(text, None, None, None)) == len(co_training.page_numbers("a", "l", "s", 1))


def test_views_teach_each_other():
    """Few labels, many rows without: the second view is told apart through the first."""
    chance = np.random.default_rng(2)

    def rows(n):
        y = (chance.random(n) < 0.6).astype(float)
        return (2.5 * y[:, None] + chance.normal(size=(n, 2)) - 1, 2.5 * y[:, None] + chance.normal(size=(n, 3)) - 1), y

    small, y = rows(40)
    pool, _ = rows(3000)
    test, truth = rows(2000)
    model = co_train(small, y, pool)
    by_text, by_page, both = model.score(*test)

    def right(p):
        return ((p >= 0.5) == (truth == 1)).mean()

    assert right(both) > 0.93 and right(both) >= right(by_text) - 0.01 and right(both) >= right(by_page) - 0.01
    alone = co_train(small, y, tuple(x[:0] for x in pool))
    assert right(both) >= right(alone.score(*test)[2]) - 0.02


def test_all_sure_rows_are_handed_over():
    """After one round the view of the page is the fit on the labels and on every row the view of the text is sure of."""
    chance = np.random.default_rng(5)

    def rows(n):
        y = (chance.random(n) < 0.6).astype(float)
        return (2.5 * y[:, None] + chance.normal(size=(n, 2)) - 1, 2.5 * y[:, None] + chance.normal(size=(n, 3)) - 1), y

    small, y = rows(200)
    pool, _ = rows(8000)
    fit = np.arange(200) % co_training.CALIBRATION != 0
    p = 1 / (1 + np.exp(-co_train(small, y, pool, rounds=0).views[0].logits(pool[0])))
    sure = (p >= co_training.SURE) | (1 - p >= co_training.SURE)
    assert (p[sure] > 0.5).sum() > 1000
    x, target = np.vstack([small[1][fit], pool[1][sure]]), np.concatenate([y[fit], p[sure] > 0.5])
    w = np.concatenate([np.ones(fit.sum()), np.full(sure.sum(), co_training.PSEUDO_WEIGHT)])
    mean = np.average(x, axis=0, weights=w)
    scale = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=w))
    beta = co_training._regression(np.clip((x - mean) / scale, -8, 8), target, w, pull=1.0)
    page = co_train(small, y, pool, rounds=1).views[1]
    assert np.allclose(page.mean, mean) and np.allclose(page.scale, scale)
    assert np.allclose(page.weights, beta, atol=1e-5)


def test_sums_over_a_table_equal_those_in_memory(spark):
    chance = np.random.default_rng(6)
    width = len(co_training.content_numbers("a")) + len(co_training.page_numbers("a", None, None, None))
    numbers = chance.normal(size=(500, width))
    table = spark.createDataFrame([(r.tolist(),) for r in numbers], "_numbers array<double>").repartition(5)

    def part(content, page):
        return np.concatenate([content.sum(axis=0), (page**2).sum(axis=0)])

    n = len(co_training.content_numbers("a"))
    expected = part(numbers[:, :n], numbers[:, n:])
    assert np.allclose(co_training._over(table)(part, width), expected)
    assert np.allclose(co_training._over(table.limit(0))(part, width), 0)


def test_one_label_gives_its_share(edge_docs, spark):
    labels = spark.createDataFrame([(5, 1), (6, None), (None, 0)], "doc_id long, quality int")
    scored = score_quality(edge_docs, fit_quality(edge_docs, labels))
    assert {r.quality.probability for r in scored.collect()} == {1.0}
    none = score_quality(edge_docs, fit_quality(edge_docs, labels.limit(0)))
    assert {r.quality.probability for r in none.collect()} == {1.0}


def test_edge_cases_are_scored(edge_docs, edge_rows, spark, no_docs):
    labels = spark.createDataFrame([(i, int(i > 9)) for i in [*range(1, 11), *range(20, 32)]], "doc_id long, quality int")
    model = fit_quality(edge_docs, labels)
    scored = score_quality(edge_docs, model)
    assert scored.columns == [*edge_docs.columns, "quality"]
    found = scored.collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in edge_rows)
    assert all(0 <= r.quality.probability <= 1 for r in found)
    assert score_quality(no_docs, model).collect() == []
    assert fit_quality(no_docs, labels).views is None


def test_sample_is_bounded(spark):
    docs = spark.range(100).selectExpr("id as doc_id", "'t' as text")
    labels = spark.range(100).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    found = labelled_sample(docs, labels, "quality", most=7).collect()
    assert Counter(r["_label"] for r in found) == {0: 7, 1: 7}


def test_sample_weights_restore_the_shares(spark):
    docs = spark.range(100).selectExpr("id as doc_id", "'t' as text")
    labels = spark.range(100).selectExpr("id as doc_id", "cast(id % 10 > 0 as int) as quality")
    for most in (7, 10, 1000):
        found = Counter()
        for r in labelled_sample(docs, labels, "quality", most=most).collect():
            found[r["_label"]] += r["_weight"]
        assert found[0] == pytest.approx(10) and found[1] == pytest.approx(90)


def test_the_share_kept_does_not_depend_on_the_sample(spark):
    """86 % good, and texts that tell little: a bounded sample of each label keeps what all labels keep."""
    chance = random.Random(8)
    rows = []
    for key in range(3000):
        good = chance.random() < 0.86
        words = [("word" if chance.random() < (0.62 if good else 0.5) else "WORD") + str(i) for i in range(25)]
        rows.append((key, " ".join(words), int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(4)
    shares = []
    for most in (50, 3000):
        model = fit_quality(docs.drop("quality"), docs.drop("text"), most_rows=most)
        found = [r.quality.probability for r in score_quality(docs.drop("quality"), model).collect()]
        shares.append(sum(p >= 0.5 for p in found) / len(found))
    assert abs(shares[0] - shares[1]) < 0.08, shares


def test_classifier_on_held_out_labels(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = dict(labels.filter("doc_id % 3 = 0").select("doc_id", "quality").collect())
    model = fit_quality(docs, labels.filter("doc_id % 3 <> 0"))
    found = {r.doc_id: r.quality.probability for r in score_quality(docs, model).collect() if r.doc_id in held}
    assert sum((p >= 0.5) == (held[k] == 1) for k, p in found.items()) >= 0.93 * len(held)


def test_classifier_query(spark, sf_dir):
    found = op1_quality_classifier(spark, sf_dir).collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.kept == (r.score >= 0.5) for r in found)


@pytest.mark.parametrize("rule", RULES, ids=lambda r: r.name)
def test_rules_vote_or_abstain(spark, rule):
    row = spark.createDataFrame([(0,) * 10], ", ".join(f"{c} long" for c in (
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        "n_distinct_words", "n_capitals", "n_marks", "n_stops")))
    assert row.select(rule.vote().alias("v")).first().v in (None, 0, 1)
