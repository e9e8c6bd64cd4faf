import random
from collections import Counter

import pytest
from frames import column
from pyspark.sql import functions as F

from headingflow.operators import labels
from headingflow.operators.concentration import coverage_thresholds, heading_distribution
from headingflow.operators.guards import require_known, unseen_values
from headingflow.operators.numbering import number_rows
from headingflow.operators.split import split_rows
from headingflow.sources.shared import materialise


@pytest.fixture(scope="module")
def headings():
    rng = random.Random(11)
    names = ["Health", "Housing", "", "Other", "Éire", "zebra", "A", *[f"topic {i}" for i in range(60)]]
    # One heading holds more than a third of the rows, many hold one or two.
    drawn = ["Health"] * 700 + rng.choices(names, k=900) + [f"rare {i}" for i in range(40)] + [None] * 12
    rng.shuffle(drawn)
    return list(enumerate(drawn))


@pytest.fixture(scope="module")
def asked(spark, headings):
    return spark.createDataFrame(headings, "id long, heading string").repartition(5).cache()


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_number_rows_equals_a_sort(spark, headings, parts):
    rows = spark.createDataFrame(headings, "id long, heading string").repartition(parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        order = [F.asc_nulls_first("heading"), F.desc("id")]
        numbered = number_rows(rows, order, "place", running={"upto": "id"})
        got = sorted(numbered.collect(), key=lambda r: r["place"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = sorted(headings, key=lambda r: ((r[1] or "").encode() if r[1] is not None else b"", r[1] is not None, -r[0]))
    assert [r["id"] for r in got] == [i for i, _ in expected]
    assert [r["place"] for r in got] == list(range(1, len(headings) + 1))
    total = 0
    for row in got:
        total += row["id"]
        assert row["upto"] == total


@pytest.mark.parametrize("min_count", [1, 2, 8, 100, 10_000])
def test_collapse_rare(asked, headings, min_count):
    filled = [h or "" for _, h in headings]
    counts = Counter(filled)
    expected = {i: ("Other" if counts[h or ""] < min_count else h or "") for i, h in headings}
    got = dict(map(tuple, labels.collapse_rare(asked, min_count=min_count).select("id", "heading_collapsed").collect()))
    assert got == expected
    summary = labels.collapse_summary(asked, min_count=min_count).first().asDict()
    n_after = len(set(expected.values()))
    assert summary == {
        "n_before": len(counts),
        "n_after": n_after,
        "n_rare": sum(n < min_count for n in counts.values()),
        "n_fewer": len(counts) - n_after,
        "rows_other": sum(h == "Other" for h in expected.values()),
    }


def test_dictionary_encode_decode(asked, headings):
    known = labels.dictionary(asked, "heading", "label_id")
    names = sorted({h or "" for _, h in headings}, key=lambda h: h.encode())
    assert dict(map(tuple, known.select("heading", "label_id").collect())) == {h: i for i, h in enumerate(names)}
    coded = labels.encode(asked, known, "heading", "label_id")
    assert {r["id"]: r["label_id"] for r in coded.collect()} == {i: names.index(h or "") for i, h in headings}
    back = labels.decode(coded.drop("heading"), known, "label_id", "heading", "heading")
    assert {r["id"]: r["heading"] for r in back.collect()} == {i: h or "" for i, h in headings}


def test_decode_unknown(spark, asked):
    known = labels.dictionary(asked, "heading", "label_id")
    ids = spark.createDataFrame([(5000,), (-1,)], "label_id int")
    assert sorted(column(labels.decode(ids, known, "label_id", "heading", "h"), "h")) == ["-1", "5000"]
    marked = labels.decode(ids, known, "label_id", "heading", "h", "__UNK_{}__")
    assert sorted(column(marked, "h")) == ["__UNK_-1__", "__UNK_5000__"]


def test_collapse_unknown(spark, asked, headings):
    known = spark.createDataFrame([("Health",), ("A",), ("A",), ("Other",)], "heading string")
    got = dict(map(tuple, labels.collapse_unknown(asked, known).select("id", "heading_eval").collect()))
    assert got == {i: h if h in ("Health", "A", "Other") else "Other" for i, h in headings}


def test_unseen_values(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,), ("c",), ("c",)], "department string")
    known = spark.createDataFrame([("a",), ("z",)], "department string")
    assert sorted(column(unseen_values(rows, known, "department"))) == ["", "b", "c"]
    with pytest.raises(ValueError, match=r"\['', 'b', 'c'\]"):
        require_known(rows, known, "department")
    assert require_known(rows.filter("department = 'a'"), known, "department") is not None


def test_distribution_and_coverage(asked, headings):
    counts = Counter(h for _, h in headings if h is not None)
    total = sum(counts.values())
    expected = sorted(counts.items(), key=lambda c: (-c[1], c[0].encode()))
    rows = sorted(heading_distribution(asked).collect(), key=lambda r: r["rank"])
    assert [(r["heading"], r["count"]) for r in rows] == expected
    upto = 0
    for place, (row, (_, n)) in enumerate(zip(rows, expected), start=1):
        upto += n
        assert row["rank"] == place
        assert row["share"] == n / total
        assert row["cum_share"] == upto / total
    for row in coverage_thresholds(asked).collect():
        upto, place = 0, 0
        while upto < row["threshold"] * total - 1e-9:
            upto += expected[place][1]
            place += 1
        assert row["top_headings"] == place
        assert (row["headings"], row["questions"]) == (len(counts), total)


def test_sparse_label_maps_decode_by_id(spark):
    rows = spark.createDataFrame(
        [([(1, 1, 0.5), (2, 2, 0.3), (3, 0, 0.2), (4, 7, 0.0)],)], "r array<struct<rank:int,class_id:int,conf:double>>"
    )
    sparse = spark.createDataFrame([("zero", 0), ("two", 2)], "heading string, label_id int")
    found = labels.decode_candidates(rows, "r", sparse).first()["candidates"]
    assert [c["heading"] for c in found] == ["1", "two", "zero", "7"]
    none = labels.decode_candidates(rows, "r", sparse.limit(0)).first()["candidates"]
    assert [c["heading"] for c in none] == ["1", "2", "0", "7"]


def test_two_headings_of_one_id_are_refused(spark):
    rows = spark.createDataFrame([([(1, 0, 0.5)],)], "r array<struct<rank:int,class_id:int,conf:double>>")
    twice = spark.createDataFrame([("a", 0), ("b", 0)], "heading string, label_id int")
    with pytest.raises(Exception, match="two headings have the id 0"):
        labels.decode_candidates(rows, "r", twice).collect()


def test_lookups_beyond_the_broadcast_size_shuffle_and_agree(spark, asked):
    known = labels.dictionary(asked, "heading", "label_id")

    def results():
        coded = labels.encode(labels.collapse_rare(asked), known, "heading", "label_id")
        split = split_rows(coded, "id")
        return split.select("id", "heading_collapsed", "label_id", "split")

    small = sorted(map(tuple, results().collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = results()
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert sorted(map(tuple, large.collect())) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookups_of_known_size_do_not_shuffle_the_rows(spark, asked):
    rows = materialise(asked, "asked")
    known = labels.dictionary(rows, "heading", "label_id")
    coded = labels.encode(labels.collapse_rare(rows), known, "heading", "label_id")
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2
