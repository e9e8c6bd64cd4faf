import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from headingflow.functions.text import word_count
from headingflow.operators import holdout, metrics

SCHEMA = (
    "id long, date date, department string, heading string, pred_heading string, pred_confidence string, "
    "candidates array<struct<rank:int,heading:string,conf:double>>"
)
NAMES = ["a", "b ", " c", "d", "e", "f", "g", "h", "i", "j", "k", "Other", "", None]


def made_rows():
    rng = random.Random(4)
    rows = []
    for i in range(900):
        # One day holds more than a third of the rows; some rows have no day.
        day = date(2026, 1, 13) + timedelta(days=0 if i % 5 < 2 else rng.randrange(6))
        names = rng.sample([n for n in NAMES if n], 10)
        conf = rng.choice(["0.3", "0.5", "bad", "NaN", None, f"{rng.random():.3f}"])
        truth = rng.choice([*names[:4], *names, *NAMES])
        pred = rng.choice([names[0]] * 6 + [None, ""])
        rows.append(
            (i, None if i % 41 == 0 else day, rng.choice(["x", "y", None]), truth, pred, conf,
             [(j + 1, n, 0.5 / (j + 1)) for j, n in enumerate(names)])
        )
    return rows


@pytest.fixture(scope="module")
def rows():
    return made_rows()


@pytest.fixture(scope="module")
def predictions(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(7).cache()


def parsed(text, default):
    try:
        value = float(text)
    except (TypeError, ValueError):
        return default
    return default if math.isnan(value) else value


def expected_day(members, ks, thresholds):
    def hit(row, k):
        if k == 1:
            return (row[4] or "") == (row[3] or "")
        truth = (row[3] or "").strip()
        return bool(truth) and truth in [c[1].strip() for c in row[6][:k]]

    n, top = len(members), ks[-1]
    conf = [parsed(r[5], 0.0) for r in members]
    out = {"n": n, "avg_conf": sum(conf) / n}
    hits = {k: [hit(r, k) for r in members] for k in ks}
    for k in ks:
        out[f"top{k}"], out[f"n_top{k}"] = sum(hits[k]) / n, sum(hits[k])
    for narrow, k in zip(ks, ks[1:]):
        out[f"n_top{k}_only"] = sum(b and not a for a, b in zip(hits[narrow], hits[k]))
    out[f"outside_top{top}"], out[f"n_outside_top{top}"] = 1 - sum(hits[top]) / n, n - sum(hits[top])
    for t in thresholds:
        auto = [i for i in range(n) if conf[i] >= t]
        wrong = [i for i in auto if not hits[1][i]]
        tag = f"t{round(t * 100):03d}"
        out[f"auto_coverage_{tag}"] = len(auto) / n
        out[f"review_rate_{tag}"] = 1 - len(auto) / n
        out[f"auto_error_rate_{tag}"] = len(wrong) / len(auto) if auto else None
        for k in ks[1:]:
            out[f"auto_top{k}_rescue_{tag}"] = sum(hits[k][i] for i in wrong) / len(auto) if auto else None
    return out


def same(got, expected):
    assert set(got) == set(expected)
    for name, value in expected.items():
        if isinstance(value, float):
            assert got[name] == pytest.approx(value, abs=1e-12), name
        else:
            assert got[name] == value, name


@pytest.mark.parametrize("ks", [(1, 4, 10), (10, 1), (1,), (1, 2, 3, 7)])
def test_daily_metrics(predictions, rows, ks):
    thresholds = (*metrics.THRESHOLDS, 0.9999)
    table = metrics.daily_metrics(predictions, ks=ks, thresholds=thresholds).collect()
    days = {r[1] for r in rows if r[1]}
    assert {r["date"] for r in table} == days
    for row in table:
        got = row.asDict()
        day = got.pop("date")
        same(got, expected_day([r for r in rows if r[1] == day], sorted(ks), thresholds))


def test_one_aggregation_whatever_the_ks_and_thresholds(predictions):
    table = metrics.daily_metrics(predictions, ks=(1, 2, 3, 4, 10), thresholds=metrics.THRESHOLDS)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_metrics_do_not_depend_on_partitions(predictions, parts):
    counts = ["date", "n", "n_top1", "n_top4_only", "n_top10_only", "n_outside_top10", "auto_error_rate_t050"]
    whole = metrics.daily_metrics(predictions).select(*counts)
    again = metrics.daily_metrics(predictions.repartition(parts)).select(*counts)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, whole.collect()))


def test_no_automatic_rows_give_null_rates(predictions):
    table = metrics.daily_metrics(predictions, thresholds=(2.0,)).collect()
    assert all(r["auto_error_rate_t200"] is None and r["auto_top4_rescue_t200"] is None for r in table)
    assert all(r["auto_coverage_t200"] == 0.0 and r["review_rate_t200"] == 1.0 for r in table)


def test_identities_of_the_daily_table(predictions):
    for r in metrics.daily_metrics(predictions).collect():
        assert r["n_top10"] + r["n_outside_top10"] == r["n"]
        assert r["n_top10"] >= r["n_top4"]
        coverage = [r[metrics.threshold_name("auto_coverage", t)] for t in metrics.THRESHOLDS]
        assert coverage == sorted(coverage, reverse=True)
        for t in metrics.THRESHOLDS:
            both = r[metrics.threshold_name("auto_coverage", t)] + r[metrics.threshold_name("review_rate", t)]
            assert both == pytest.approx(1.0)


def test_daily_top1_headline_and_validation(predictions, rows):
    dated = [r for r in rows if r[1]]
    for row in metrics.daily_top1(predictions, "heading").collect():
        members = [r for r in dated if r[1] == row["date"]]
        expected = expected_day(members, [1], ())
        same({k: row[k] for k in ("n", "avg_conf", "top1", "n_top1")},
             {k: expected[k] for k in ("n", "avg_conf", "top1", "n_top1")})
    whole = expected_day(rows, [1, 4, 10], ())
    head = metrics.headline(predictions, ks=(4, 10)).first().asDict()
    same(head, {k: whole[k] for k in ("n", "top1", "top4", "top10", "outside_top10")})
    three = expected_day(rows, [1, 3], ())
    checked = metrics.validation_metrics(predictions).first().asDict()
    same(checked, {"n": whole["n"], "top1_accuracy": three["top1"], "top3_accuracy": three["top3"]})
    share = metrics.other_share(predictions, "heading").first()
    assert share["n_other"] == sum(r[3] == "Other" for r in rows)


def test_headline_per_key(predictions, rows):
    got = {r["department"]: r["n"] for r in metrics.headline(predictions, keys=["department"]).collect()}
    assert got == {d: sum(r[2] == d for r in rows) for d in ("x", "y", None)}


def test_empty_headline(predictions):
    row = metrics.headline(predictions.limit(0)).first()
    assert row["n"] == 0 and row["top1"] is None


def test_column_names():
    assert metrics.threshold_name("review_rate", 0.3) == "review_rate_t030"
    assert metrics.sink_name("review_rate_t030") == "review_rate_t0.30"
    assert metrics.sink_name("auto_top10_rescue_t070") == "auto_top10_rescue_t0.70"
    assert metrics.sink_name("n_top1") == "n_top1"


def test_bad_ks(predictions):
    for ks, max_k in [((), 10), ((0, 4), 10), ((1, 11), 10)]:
        with pytest.raises(ValueError):
            metrics.daily_metrics(predictions, ks=ks, max_k=max_k or 1) if ks else metrics.report_ks(ks, max_k)


def test_holdout_report(predictions, rows):
    report = holdout.holdout_report(predictions).first()
    n = len(rows)
    top1 = sum((r[4] or "") == (r[3] or "") for r in rows)
    topk = sum(bool(r[3]) and r[3] in [r[4] or "", *[c[1] for c in r[6][:5]]] for r in rows)
    assert (report["n"], report["top1"], report["topk"]) == (n, pytest.approx(top1 / n), pytest.approx(topk / n))
    assert report["other_rate"] == pytest.approx(sum((r[4] or "").lower() == "other" for r in rows) / n)


def test_review_sweep_leaves_missing_confidence_out(predictions, rows):
    for row in holdout.review_sweep(predictions).collect():
        items = sum((parsed(r[5], None) is not None) and parsed(r[5], None) < row["threshold"] for r in rows)
        assert (row["items"], row["review_rate"]) == (items, pytest.approx(items / len(rows)))


def test_department_summary(predictions, rows):
    table = holdout.department_summary(predictions).collect()
    assert [r["n"] for r in table] == sorted([r["n"] for r in table], reverse=True)
    for row in table:
        members = [r for r in rows if r[2] == row["department"]]
        conf = [parsed(r[5], None) for r in members]
        conf = [c for c in conf if c is not None]
        assert row["n"] == len(members)
        assert row["top1"] == pytest.approx(sum((r[4] or "") == (r[3] or "") for r in members) / len(members))
        assert row["avg_conf"] == pytest.approx(sum(conf) / len(conf))


@pytest.mark.parametrize("size", [3, 50, 1000])
def test_error_sample(predictions, rows, size):
    keep = ["department", "heading", "pred_heading", "pred_confidence", "absent"]
    got = {r["id"]: r["pred_confidence"] for r in holdout.error_sample(predictions, "id", keep, size=size).collect()}
    wrong = [(parsed(r[5], -1.0), r[0]) for r in rows if (r[4] or "") != (r[3] or "")]
    chosen = sorted(wrong, key=lambda w: (-w[0], w[1]))[:size] + sorted(wrong)[:size]
    assert got == {i: c for c, i in chosen}


def test_text_length_stats(spark):
    counts = [0, 1, 1, 2, 3, 5, 8, 13, 21, 400]
    rows = spark.createDataFrame([(" ".join(["w"] * n),) for n in counts] + [(None,)], "t string")
    stats = {r["kind"]: r for r in metrics.text_length_stats(rows, {"raw": word_count(F.col("t"))}).collect()}
    ordered = sorted([*counts, 0])
    place = 0.95 * (len(ordered) - 1)
    low = int(place)
    p95 = ordered[low] + (place - low) * (ordered[low + 1] - ordered[low])
    assert stats["raw"]["mean"] == pytest.approx(sum(counts) / 11)
    assert stats["raw"]["median"] == ordered[5]
    assert stats["raw"]["p95"] == pytest.approx(p95)
