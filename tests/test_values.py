from datetime import date

import pytest
from frames import column
from pyspark.sql import functions as F

from headingflow.functions.values import first_non_empty, number, parse_day

DAYS = [
    ("2026-02-03", date(2026, 2, 3)),
    ("2026-2-3", date(2026, 2, 3)),
    ("2026/02/03", date(2026, 2, 3)),
    ("03-02-2026", date(2026, 2, 3)),
    ("3/2/2026", date(2026, 2, 3)),
    ("12/11/2026", date(2026, 11, 12)),
    ("2026-02-03T23:59:59", date(2026, 2, 3)),
    ("2026-02-03T1:2:3", date(2026, 2, 3)),
    ("2026-02-03T23:59:59.5Z", date(2026, 2, 3)),
    ("2026-02-03T23:59:59Z", date(2026, 2, 3)),
    ("2026-02-03T23:30:00+05:30", date(2026, 2, 3)),
    ("2026-02-03T00:15:00.123456-11:00", date(2026, 2, 3)),
    ("2026-02-03 10:00", date(2026, 2, 3)),
    ("20260203", date(2026, 2, 3)),
    ("20260203T101500", date(2026, 2, 3)),
    ("  2026-02-03\n", date(2026, 2, 3)),
    ("", None),
    (" ", None),
    (None, None),
    ("2026-13-01", None),
    ("2026-02-30", None),
    ("30/02/2026", None),
    ("2026/02-03", None),
    ("02/13/2026", None),
    ("2026-02-03T25:00:00", None),
    ("2026-02-03Tnoon", None),
    ("3 February 2026", None),
    ("26-02-03", None),
    ("not-a-date", None),
]


def test_parse_day(spark):
    rows = spark.createDataFrame([(s,) for s, _ in DAYS], "s string").select("s", parse_day("s").alias("d"))
    assert {r["s"]: r["d"] for r in rows.collect()} == dict(DAYS)


@pytest.mark.parametrize("zone", ["UTC", "Pacific/Kiritimati", "America/Los_Angeles"])
def test_the_session_zone_does_not_move_the_day(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(s,) for s, _ in DAYS], "s string")
        assert column(rows.select(parse_day("s"))) == [d for _, d in DAYS]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_number(spark):
    texts = ["0.25", " 1 ", "bad", "", "NaN", None, "1e-3", "-2"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert column(rows.select(number(F.col("t")))) == [0.25, 1.0, None, None, None, None, 0.001, -2.0]
    assert column(rows.select(number(F.col("t"), default=0.0)))[2:6] == [0.0] * 4
    doubles = spark.createDataFrame([(float("nan"),), (None,), (0.5,)], "t double")
    assert column(doubles.select(number(F.col("t"), default=-1))) == [-1.0, -1.0, 0.5]


def test_first_non_empty(spark):
    rows = spark.createDataFrame(
        [(None, " \t", " x "), ("a", "b", None), (None, None, None)], "a string, b string, c string"
    )
    assert column(rows.select(first_non_empty("a", "b", "c"))) == ["x", "a", ""]
