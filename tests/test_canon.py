import json
from datetime import date

import pytest

from headingflow.operators.canon import extract_questions, zip_arrays

NESTED = {"question": {"showAs": " q1 ", "date": "2026-01-13", "debateSection": {"showAs": "h1"}, "to": {"showAs": "d1"}}}
FLAT = {"question": "q2", "heading": "h2", "department": "d2", "date": "14/01/2026"}
ROOTED = {"showAs": "q3", "debateSection": {"showAs": "h3"}, "to": {"showAs": "d3"}, "contextDate": "2026-01-15T10:00:00Z"}


def extracted(spark, *documents, **options):
    texts = [(d if isinstance(d, str) else json.dumps(d),) for d in documents]
    rows = extract_questions(spark.createDataFrame(texts, "value string"), **options)
    return sorted((r.question, r.heading, r.department, r.date) for r in rows.collect())


ALL = [
    ("q1", "h1", "d1", date(2026, 1, 13)),
    ("q2", "h2", "d2", date(2026, 1, 14)),
    ("q3", "h3", "d3", date(2026, 1, 15)),
]


@pytest.mark.parametrize("key", ["items", "results", "data", "pqs", "questions", None])
def test_envelopes(spark, key):
    items = [NESTED, FLAT, ROOTED]
    assert extracted(spark, {key: items} if key else items) == ALL


def test_the_first_key_that_holds_a_list_wins(spark):
    document = {"questions": [NESTED], "data": [FLAT], "results": "none", "items": {"a": [ROOTED]}}
    assert extracted(spark, document) == [ALL[1]]


def test_incomplete_items_drop_out(spark):
    items = [
        17, "text", None, [FLAT], {}, FLAT,
        {**FLAT, "heading": "  "}, {**FLAT, "department": None}, {**FLAT, "date": "soon"},
        {"question": {}, "heading": "h", "department": "d", "date": "2026-01-01"},
    ]
    assert extracted(spark, items) == [ALL[1]]


def test_precedence_and_fallbacks(spark):
    nested_wins = {**NESTED, "heading": "other", "department": "other", "date": "2027-01-01", "showAs": "other"}
    # An object without the wanted field gives way to the next path.
    object_question = {"question": {"to": {"showAs": "d3"}}, **ROOTED}
    numbers = {"question": 7, "heading": 8, "department": 9, "question2": 1, "replyDate": "2026-01-02"}
    blank_date = {**FLAT, "date": " ", "contextDate": "2026-03-01", "replyDate": "2026-04-01"}
    reply = {"question": {**NESTED["question"], "date": None, "replyDate": "2026-05-01"}, "replyDate": "2026-06-01"}
    assert extracted(spark, [nested_wins]) == [ALL[0]]
    assert extracted(spark, [object_question]) == [ALL[2]]
    assert extracted(spark, [numbers]) == [("7", "8", "9", date(2026, 1, 2))]
    assert extracted(spark, [blank_date])[0][3] == date(2026, 3, 1)
    assert extracted(spark, [reply])[0][3] == date(2026, 5, 1)


def test_a_document_without_a_list_is_an_error(spark):
    with pytest.raises(Exception, match="not a list"):
        extracted(spark, {"total": 3})
    with pytest.raises(Exception, match="MALFORMED_RECORD|JsonParseException"):
        extracted(spark, "{broken")
    assert extracted(spark, {"total": 3}, "{broken", [FLAT], strict=False) == [ALL[1]]


def test_zip_arrays_stops_at_the_shorter(spark):
    rows = spark.createDataFrame(
        [(1, "[3, 4]", '["a", "b"]'), (2, "[5]", '["c", "d"]'), (3, "[]", "[]")], "id long, d string, q string"
    )
    got = sorted(map(tuple, zip_arrays(rows, "d", "q", "id").collect()))
    assert got == [(1, 0, 3, "a"), (1, 1, 4, "b"), (2, 0, 5, "c")]
