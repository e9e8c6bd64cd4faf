import random
from collections import defaultdict

import numpy as np
import pytest

from headingflow.llm.components import components
from headingflow.llm.near_duplicates import near_duplicates
from headingflow.llm.queries import op6_near_duplicates
from headingflow.llm.shingles import Sketcher, shingles, word_hashes


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(rows, percent=85):
    """Component by row, all pairs compared."""
    sets = defaultdict(set)
    for key, text in rows:
        if key is not None:
            sets[key] |= shingle_set(text)
    parent = {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def changed(words, share, chance):
    return [chance.choice(["q", "z", "k"]) + str(chance.randint(0, 99)) if chance.random() < share else w for w in words]


@pytest.fixture(scope="module")
def families():
    """Groups of copies and near copies around the threshold, among them chains."""
    chance = random.Random(7)
    rows = []
    for family in range(12):
        base = [f"w{chance.randint(0, 400)}" for _ in range(chance.randint(40, 200))]
        last = base
        for member in range(12):
            last = changed(last if member % 3 else base, chance.choice([0, 0.005, 0.01, 0.02]), chance)
            rows.append((len(rows), " ".join(w.upper() if member % 4 == 3 else w for w in last)))
    return rows


def test_families_equal_brute_force(spark, families):
    found = near_duplicates(spark.createDataFrame(families, "doc_id long, text string")).collect()
    expected = brute_components(families)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert {r.doc_id: r.n_shingles for r in found} == {k: len(shingle_set(t)) for k, t in families}
    assert len(set(expected.values())) < len(families) / 2


def test_edge_cases(edge_docs, edge_rows):
    found = near_duplicates(edge_docs).collect()
    assert len(found) == len(edge_rows)
    expected = brute_components([(r[0], r[1]) for r in edge_rows])
    for r in found:
        assert r.component_id == (None if r.doc_id is None else expected[r.doc_id])
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    assert {r.doc_id: r.n_shingles for r in found if r.doc_id in (1, 2, 3, 4)} == {1: 0, 2: 0, 3: 0, 4: 1}


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).collect() == []


def test_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: r.component_id for r in op6_near_duplicates(spark, sf_dir).collect()}
    assert found == brute_components(rows)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    labels, _ = components(links)
    assert dict(map(tuple, labels.collect())) == {**dict.fromkeys(range(41), 0), 90: 90, 100: 90}


def test_word_hashes_do_not_depend_on_the_piece(monkeypatch):
    words = b" ".join(str(i * i).encode() for i in range(400))
    whole = word_hashes(words)
    monkeypatch.setattr("headingflow.llm.shingles.PIECE", 50)
    from headingflow.llm import shingles as module

    module._piece_powers.cache_clear()
    assert (word_hashes(words) == whole).all() and len(set(whole.tolist())) == 400
    assert (word_hashes(b"a " + b"x" * 500) == np.concatenate([word_hashes(b"a"), word_hashes(b"x" * 500)])).all()
    module._piece_powers.cache_clear()


@pytest.mark.parametrize("shared", [0.7, 0.85, 0.95])
def test_odd_sketches_estimate_similarity(shared):
    chance = np.random.default_rng(3)
    common = chance.integers(0, 1 << 63, int(2000 * shared), dtype=np.uint64)
    parts = [np.unique(np.concatenate([common, chance.integers(0, 1 << 63, 2000 - len(common), dtype=np.uint64)])) for _ in "ab"]
    truth = len(np.intersect1d(*parts)) / len(np.union1d(*parts))
    sketcher = Sketcher(20, 5, 384, 1536)
    owner = np.repeat([0, 1], [len(p) for p in parts])
    odd = sketcher.odd_sketches(sketcher.samples(owner, np.concatenate(parts)))
    apart = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in odd[0] ^ odd[1])
    estimate = 1 + 1536 / 2 * np.log(1 - 2 * apart / 1536) / (2 * 384)
    assert abs(estimate - truth) < 0.08


def test_shingles_of_short_texts():
    counts = np.array([0, 2, 5, 6, 2])
    hashes = word_hashes(b"a b a b c d e a b c d e f a b")
    owner, made = shingles(counts, hashes, 5)
    assert np.bincount(owner, minlength=5).tolist() == [0, 1, 1, 2, 1]
    assert made[owner == 1][0] == made[owner == 4][0]
