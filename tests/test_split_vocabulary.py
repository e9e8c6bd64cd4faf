import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from frames import column

from headingflow.operators import split as split_module
from headingflow.operators.split import split_by_day, split_rows
from headingflow.operators.vocabulary import encode_sequences, vocabulary, words

LABELS = ["hot"] * 3000 + ["b"] * 5 + ["c"] * 14 + ["d"] * 15 + ["single"] + ["e"] * 100 + [None] * 30


def expected_split(rows, share=0.1, seed=42, label=lambda r: r[1] or ""):
    groups = defaultdict(list)
    for row in rows:
        groups[label(row)].append((hashlib.md5(f"{row[0]}|{seed}".encode()).hexdigest(), row[0]))
    val = set()
    for members in groups.values():
        quota = math.floor(share * len(members) + 0.5)
        val |= {i for _, i in sorted(members)[:quota]}
    return {row[0]: "val" if row[0] in val else "train" for row in rows}


@pytest.fixture(scope="module")
def rows():
    return list(enumerate(LABELS))


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("share, seed", [(0.1, 42), (0.25, 7), (0.0, 1), (1.0, 1)])
def test_split_equals_a_sort_per_label(spark, rows, share, seed, digits, monkeypatch):
    monkeypatch.setattr(split_module, "_BUCKET_DIGITS", digits)
    asked = spark.createDataFrame(rows, "id long, heading string")
    got = dict(map(tuple, split_rows(asked, "id", share=share, seed=seed).select("id", "split").collect()))
    assert got == expected_split(rows, share, seed)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_split_does_not_depend_on_partitions(spark, rows, parts):
    asked = spark.createDataFrame(rows, "id long, heading string").repartition(parts)
    got = {r["id"]: r["split"] for r in split_rows(asked, "id").collect()}
    assert got == expected_split(rows)
    assert got[LABELS.index("single")] == "train"


def test_split_without_strata(spark, rows):
    asked = spark.createDataFrame(rows, "id long, heading string")
    got = {r["id"]: r["split"] for r in split_rows(asked, "id", label=None).collect()}
    assert got == expected_split(rows, label=lambda r: "")


def test_split_by_day(spark):
    asked = spark.range(10)
    assert Counter(column(split_by_day(asked, "id", 7), "split")) == {"train": 7, "val": 3}


def plain_words(text):
    return [w for w in re.sub(r"[!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n]", " ", (text or "").lower()).split(" ") if w]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    pool = [f"w{i}" for i in range(300)] + ["The", "covid-19", "a_b", "é", "x\ty", "it's", "日本"]
    made = [" ".join(rng.choices(pool, k=rng.randint(0, 40))) + " the the" * rng.randint(0, 9) for _ in range(200)]
    return list(enumerate([*made, None, "", "---", "the " * 500]))


@pytest.mark.parametrize("num_words", [2, 3, 50, 20000])
def test_vocabulary_and_sequences(spark, texts, num_words):
    asked = spark.createDataFrame(texts, "id long, t string").repartition(3)
    counts = Counter(w for _, t in texts for w in plain_words(t))
    ranked = sorted(counts.items(), key=lambda c: (-c[1], c[0].encode()))
    ids = {w: i for i, (w, _) in enumerate(ranked, start=2) if i < num_words}
    made = vocabulary(asked, "t", num_words)
    assert {r["word"]: (r["word_id"], r["n"]) for r in made.collect()} == {w: (i, counts[w]) for w, i in ids.items()}
    length = 30
    for row in encode_sequences(asked, made, "t", length=length).collect():
        expected = [ids.get(w, 1) for w in plain_words(row["t"])][:length]
        assert row["word_ids"] == expected + [0] * (length - len(expected))


def test_words(spark):
    rows = spark.createDataFrame([("It's a B-2, ok_now\tyes\nno\\/",), (None,)], "t string")
    assert column(rows.select(words(rows.t))) == [["it's", "a", "b", "2", "ok", "now", "yes", "no"], []]
