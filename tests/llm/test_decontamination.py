import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from headingflow.llm.decontamination import GramIndex, aligned, aligned_all, find_passages, normal, segments_of
from headingflow.llm.queries import op7_decontamination

VOCABULARY = "the of eaner thnt on in ouble rest ing a and".split()


def distance(segment, text):
    """Fewest edits of the segment against any part of the text."""
    before = [0] * (len(text) + 1)
    for i, c in enumerate(segment):
        row = [i + 1]
        for j in range(1, len(text) + 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (text[j - 1] != c)))
        before = row
    return min(before)


def edited(text, n, chance):
    letters = list(text)
    for _ in range(n):
        at, kind = chance.randrange(len(letters)), chance.random()
        if kind < 0.4:
            letters[at] = chance.choice("abq")
        elif kind < 0.7:
            letters.insert(at, "k")
        elif len(letters) > 1:
            letters.pop(at)
    return "".join(letters)


@pytest.fixture(scope="module")
def items():
    chance = random.Random(3)
    return [(i, " ".join(chance.choice(VOCABULARY) for _ in range(chance.randint(2, 60)))) for i in range(20)]


@pytest.fixture(scope="module")
def docs(items):
    chance = random.Random(4)

    def noise():
        return "".join(chance.choice("xyz qw") for _ in range(chance.randint(0, 80)))

    made = []
    for key in range(60):
        parts = [edited(chance.choice(items)[1], chance.randint(0, 14), chance).upper() for _ in range(chance.randint(0, 2))]
        made.append((key, noise() + "".join(f" \n {p}  {noise()}" for p in parts)))
    return made


def test_all_passages_equal_brute_force(spark, docs, items):
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 21, 500):  # one pass, and several
        found = find_passages(table, benchmark, block=block).collect()
        expected = {
            (key, s.item, s.number)
            for key, text in docs
            for i, item in items
            for s in segments_of(i, item)
            if distance(s.points.tolist(), normal(text)[0].tolist()) <= s.edits
        }
        assert {(r.doc_id, r.item_id, r.segment) for r in found} == expected and len(expected) > 30
        texts = dict(docs)
        for r in found:
            segment = next(s for s in segments_of(r.item_id, dict(items)[r.item_id]) if s.number == r.segment)
            part = normal(texts[r.doc_id][r.start : r.end])[0]
            assert distance(segment.points.tolist(), part.tolist()) <= r.edits <= segment.edits


def test_passages_at_the_start_equal_brute_force(spark):
    """Characters left out at the front, or anywhere, of a passage that the document begins with or soon has."""
    chance = random.Random(6)
    items = [(i, " ".join(chance.choice(VOCABULARY) for _ in range(30))) for i in range(8)]
    docs = []
    for offset in range(21):
        for lost in (0, 1, 3, 6, 12):
            letters = list(chance.choice(items)[1])
            for _ in range(lost):
                letters.pop(chance.randrange(len(letters)) if chance.random() < 0.5 else 0)
            docs.append((len(docs), "z" * offset + "".join(letters) + chance.choice(["", " zq xz"])))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = find_passages(table, spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = {
        (key, s.item, s.number)
        for key, text in docs
        for i, item in items
        for s in segments_of(i, item)
        if distance(s.points.tolist(), normal(text)[0].tolist()) <= s.edits
    }
    assert {(r.doc_id, r.item_id, r.segment) for r in found} == expected and len(expected) > 80
    for r in found:
        segment = next(s for s in segments_of(r.item_id, dict(items)[r.item_id]) if s.number == r.segment)
        part = normal(dict(docs)[r.doc_id][r.start : r.end])[0]
        assert distance(segment.points.tolist(), part.tolist()) <= r.edits <= segment.edits


def test_lemma_bound_is_positive():
    for n in range(7, 400):
        for s in segments_of(0, "abcdefghij" * 40)[:1] + segments_of(0, ("abcdefghij" * 40)[:n]):
            assert s.bound >= 1


def test_alignment_of_a_shifted_text():
    segment, text = (normal(t)[0] for t in ("hello wonderful world", "xx helo wonderfull world yy"))
    edits, begin, end = aligned(segment, text, 4, 8)
    assert edits == 2 and bytes(text[begin:end].tolist()) == b"helo wonderfull world"
    assert aligned(segment, normal("nothing of the kind is here")[0], 4, 8) is None


def test_edge_cases(edge_docs, no_docs, edge_rows, spark):
    text = edge_rows[4][1]
    benchmark = spark.createDataFrame(
        [(1, None), (2, ""), (3, "tiny"), (4, text), (5, text), (None, text)], "item_id long, text string"
    )
    found = find_passages(edge_docs, benchmark).collect()
    whole = [r for r in found if r.segment == 0]
    assert sorted(r.doc_id for r in whole if r.item_id == 4) == [5, 5, 6]
    assert {r.item_id for r in found} == {4, 5, None}
    assert find_passages(no_docs, benchmark).collect() == []
    assert find_passages(edge_docs, benchmark.limit(0)).collect() == []


def test_a_document_boundary_is_no_text():
    index = GramIndex(segments_of(0, "abcdefghijklmnopqrstuvwxyz"))
    assert len(index.bands(normal("nothing")[0], np.array([0]))) == 0


def test_many_alignments_at_once_are_those_of_each():
    chance = random.Random(8)
    cases = []
    for _ in range(200):
        segment = "".join(chance.choice("abc ") for _ in range(chance.randint(7, 60)))
        text = "".join(chance.choice("abc ") for _ in range(chance.randint(0, 9))) + edited(segment, chance.randint(0, 8), chance)
        cases.append((normal(segment)[0], normal(text)[0], chance.randint(0, 7)))
    found = aligned_all(cases, 10)
    assert found == [aligned(*c, 10) for c in cases] and 40 < sum(f is not None for f in found) < 160
    for (segment, text, edits), made in zip(cases, found, strict=True):
        if made:
            assert distance(segment.tolist(), text[made[1] : made[2]].tolist()) <= made[0] <= edits


def test_a_text_that_repeats_itself_takes_bounded_memory():
    segments = [s for i in range(20) for s in segments_of(i, "ha " * (40 + i))]
    index = GramIndex(segments)
    points = normal("ha " * 4000)[0]
    tracemalloc.start()
    bands = index.bands(points, np.array([0]))
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    slow = Counter()
    for shift in (0, index.width // 2):
        for owner, segment in enumerate(segments[:2]):
            m = len(segment.points) - 6
            for place in range(len(points) - 6):
                for inside in range(m):
                    if (place - inside) % 3 == 0:
                        slow[0, owner, (place - inside + (1 << 20) + shift) // index.width * index.width - shift - (1 << 20)] += 1
    expected = sorted(list(k) for k, n in slow.items() if n >= segments[k[1]].bound)
    assert sorted(bands[bands[:, 1] < 2].tolist()) == expected
    assert most < 150 << 20


def test_documents(spark, sf_dir):
    found = {(r.doc_id, r.item_id) for r in op7_decontamination(spark, sf_dir).collect()}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    exact = {(d, i.item_id) for d, t in texts for i in items if i.text in t}
    assert exact <= found and len(found) <= len(exact) + 2
