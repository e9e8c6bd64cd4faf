"""Documents and tables of one file, read in many byte ranges, against readers that take them whole."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from headingflow.operators.canon import explode_items, extract_questions
from headingflow.plans.derived import write_huge_documents
from headingflow.sources.files import read_csv, read_documents
from headingflow.sources.large_csv import read_csv_ranges, read_records
from headingflow.sources.large_json import ItemCutter, RangeSum, _after, list_in, parse_items, read_items, read_questions


@pytest.fixture(scope="module")
def small_ranges(spark):
    """A few hundred bytes in a range."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "400")
    spark.conf.set(names[1], "64")
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


TRICKY = ['a "quoted" } [ text', "back\\slash\\", "line\nbreak", "é中😀", "", "]}", '\\"', "x" * 700, "{\"a\": [1,2]}"]


def value(chance, depth=0):
    kind = chance.randrange(6 if depth < 3 else 3)
    if kind == 0:
        return chance.choice([None, True, 17, -0.5])
    if kind < 3:
        return chance.choice(TRICKY)
    if kind == 3:
        return [value(chance, depth + 1) for _ in range(chance.randint(0, 3))]
    return {chance.choice(TRICKY) or "k": value(chance, depth + 1) for _ in range(chance.randint(0, 3))}


def documents(seed):
    chance = random.Random(seed)
    items = [value(chance) for _ in range(chance.randint(0, 60))]
    other = [{"more": value(chance)} for _ in range(5)]
    yield items
    yield {"meta": {"a": [1, {"b": 2}]}, "data": items}
    yield {"questions": other, "results": {"x": items}, "items": "none", "data": items, "z": other}
    yield {"data": other, "note": TRICKY[0], "items": items}
    yield []
    yield {"pqs": []}


def test_items_of_documents_in_ranges(small_ranges, tmp_path):
    spark, chance = small_ranges, random.Random(1)
    for seed in range(4):
        for i, document in enumerate(documents(seed)):
            text = json.dumps(document, ensure_ascii=chance.random() < 0.5, indent=chance.choice([None, 1]))
            (tmp_path / f"{seed}-{i}.json").write_text(text + chance.choice(["", "\n", "  "]))
    found = parse_items(read_items(spark, str(tmp_path)))
    got = found.items.select("document", "position", "item").collect()
    whole = read_documents(spark, str(tmp_path)).select(F.col("_metadata.file_path").alias("document"), "value")
    expected = explode_items(whole, "value").select("document", "position", F.to_json("item").alias("item")).collect()

    def plain(rows):
        return sorted((r.document, r.position, json.dumps(json.loads(r.item or "null"), sort_keys=True)) for r in rows)

    assert plain(got) == plain(expected) and len(got) > 200
    assert found.rejects.count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_any_cut_gives_the_same_items(seed):
    """The scanners by themselves, with bounds between any two fragments."""
    chance = random.Random(seed)
    for document in documents(seed):
        parts = json.dumps(document).encode().split(b"}")
        if not parts[-1]:
            parts.pop()
        level = 2 if isinstance(document, dict) else 1
        answers = set()
        for share in (0.0, 0.3, 1.0):
            ranges = [[]]
            for part in parts:
                if ranges[-1] and chance.random() < share:
                    ranges.append([])
                ranges[-1].append(part)
            state, items, held, skeleton, opened = (False, 0), [], b"", b"", 0
            for start, fragments in enumerate(ranges):
                total, cutter = RangeSum(), ItemCutter(*state, level)
                rows = [row for f in fragments for row in cutter.feed(f)] + cutter.finish()
                for f in fragments:
                    total.feed(f)
                names = [c.split()[0] for c in RangeSum.SCHEMA.split(", ")]
                state = _after(state, dict(zip(names, total.finish()[0], strict=True)) | {"start": start})
                for kind, _, ordinal, _, last, text in rows:
                    if kind == "skeleton":
                        skeleton += text
                        opened += ordinal + 1
                        continue
                    held = text if kind in ("whole", "tail") else held + text
                    if kind in ("whole", "tail"):
                        at = opened + ordinal
                    if kind in ("whole", "head") and not (last and not held.strip()):
                        items.append((at, held))
            chosen, reason = list_in(skeleton, ("items", "results", "data", "pqs", "questions"))
            assert reason is None
            answers.add(tuple(json.dumps(json.loads(t)) for o, t in items if o == chosen))
        whole = document if isinstance(document, list) else next(
            document[k] for k in ("items", "results", "data", "pqs", "questions") if isinstance(document.get(k), list)
        )
        assert answers == {tuple(json.dumps(i) for i in whole)}


def test_questions_equal_those_of_the_whole_document(small_ranges, tmp_path):
    chance = random.Random(9)
    items = [
        chance.choice([
            {"question": {"showAs": f"q{i} {chance.choice(TRICKY)}", "date": "2026-01-13", "debateSection": {"showAs": "h"}, "to": {"showAs": "d"}}},
            {"question": f"q{i}", "heading": "h", "department": "d", "date": "14/01/2026"},
            {"question": f"q{i}", "heading": " ", "department": "d", "date": "14/01/2026"},
            i,
        ])
        for i in range(80)
    ]
    (tmp_path / "one.json").write_text(json.dumps({"total": 80, "results": items}))
    names = ["position", "question", "heading", "department", "date"]
    got, rejects = read_questions(small_ranges, str(tmp_path))
    expected = extract_questions(read_documents(small_ranges, str(tmp_path)))
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, expected.select(*names).collect()))
    assert got.count() > 20 and rejects.count() == 0


def test_rejects_cost_no_other(small_ranges, tmp_path):
    good = '{"question": "q", "heading": "h", "department": "d", "date": "2026-01-01"}'
    twice = good.replace("{", '{"question": "old", ', 1)
    number = good.replace("{", '{"score": NaN, "low": [-Infinity], ', 1)
    broken = good.replace("}", ", }")
    files = {
        "items.json": f"[{good}, {twice}, {number}, {broken}, {{'x'}}, nope, {good}]",
        "none.json": '{"total": 3}',
        "scalar.json": "17",
        "broken.json": '{"data": [] "x": 1}',
        "cut.json": f'{{"data": [{good}, {{"question": "never ends',
        "empty.json": "",
        "two.json": f"[{good}] [{good}]",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    rows, rejects = read_questions(small_ranges, str(tmp_path))
    got = sorted((r.document.rsplit("/", 1)[1], r.position, r.question) for r in rows.collect())
    assert got == [("cut.json", 0, "q"), *(("items.json", i, "q") for i in (0, 1, 2, 6))]
    reasons = sorted((r.document.rsplit("/", 1)[1], -1 if r.position is None else r.position, r.reason.split(":")[0]) for r in rejects.collect())
    assert reasons == [
        ("broken.json", -1, "the document is not JSON"),
        ("cut.json", 1, "the document ends inside the item"),
        *(("items.json", i, "the item is not JSON") for i in (3, 4, 5)),
        ("none.json", -1, "the document is not a list and holds none"),
        ("scalar.json", -1, "the document is not a list and holds none"),
        ("two.json", -1, "the document is not JSON"),
    ]


def test_a_document_is_read_by_several_tasks(small_ranges, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([{"k": "x" * 50} for _ in range(100)]))
    from headingflow.sources.byte_ranges import fragments

    assert fragments(small_ranges, str(tmp_path), "}").select("start").distinct().count() > 10


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_csv_in_ranges(small_ranges, tmp_path, ending):
    chance = random.Random(3)
    rows = [[str(i), chance.choice([*TRICKY, "a, b", ' "x" ', "NA", "two\r\nlines", ",\n\"\n,"]), chance.choice(["", "y"])] for i in range(300)]
    out = io.StringIO()
    csv.writer(out, lineterminator=ending).writerows([["id", "text", "other"], *rows])
    (tmp_path / "one.csv").write_bytes(out.getvalue().encode())
    schema = "id long, text string, other string"
    got = read_csv_ranges(small_ranges, str(tmp_path), schema)
    expected = read_csv(small_ranges, str(tmp_path), schema)
    if ending == "\n":  # with the other, Spark's reader changes the line breaks in texts to those of the file
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    by_hand = sorted((int(i), t or None, o or None) for i, t, o in rows)
    assert sorted(map(tuple, got.collect())) == by_hand
    assert read_records(small_ranges, str(tmp_path)).select("start").distinct().count() > 10
    with pytest.raises(ValueError, match="header"):
        read_csv_ranges(small_ranges, str(tmp_path), "id long, other string, text string")


def test_documents_grow_in_number_with_the_parts_of_their_items(spark, tmp_path):
    item = """'{"question": "q', id, '", "heading": "h", "department": "d", "date": "2026-01-13"}'"""
    items = spark.range(0, 90, 1, 9).selectExpr("id as pq_id", f"concat({item}) as item")
    write_huge_documents(items, str(tmp_path / "many"), documents=2)
    write_huge_documents(items.coalesce(1), str(tmp_path / "few"), documents=2)
    for name, files in (("many", 9), ("few", 2)):
        rows, rejects = read_questions(spark, str(tmp_path / name))
        assert len(list((tmp_path / name).glob("part-*"))) == files and rejects.isEmpty()
        assert sorted(r["question"] for r in rows.collect()) == sorted(f"q{i}" for i in range(90))
