import math
import random
import re
from collections import Counter

import duckdb
import pytest

from headingflow.llm import ranked_search as rs
from headingflow.llm.queries import ORACLE, QUERIES

TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute(docs, items, k=10):
    """Every document against every item, by the definition."""
    lowered = [(d, Counter(TERMS.findall(re.sub("[A-Z]", lambda c: c[0].lower(), t or "")))) for d, t in docs]
    lowered = [(d, c) for d, c in lowered if c]
    n, total = len(lowered), sum(c.total() for _, c in lowered)
    df = Counter(t for _, c in lowered for t in c)
    found = []
    for item, text in items:
        scores = []
        for d, c in lowered:
            m = 10 + (90 * c.total() * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(TERMS.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or "")))
                if t in c
            )
            if score > 0:
                scores.append((-score, d is not None, d or 0, d))
        found += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(found, key=str)


def answer(spark, docs, items, k=10):
    index = rs.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    rows = rs.search(index, spark.createDataFrame(items, "item_id long, text string"), k).collect()
    index.drop()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(rs, "MOST_WIDTH", 64)  # coordinates are shared
    monkeypatch.setattr(rs, "FIRST_TRIES", 3)
    monkeypatch.setattr(rs, "BLOCK_TERMS", 20)  # several blocks
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Éa", "éa", "x", "X", "a-b", "1"]
    docs = [(i, " ".join(chance.choices(words, k=chance.choice([1, 5, 40, 400])))) for i in range(200)]
    docs += [(500 + i, docs[i][1]) for i in range(20)]  # copies tie
    items = [(i, " ".join(chance.choices(words, k=chance.choice([1, 3, 12])))) for i in range(15)]
    assert answer(spark, docs, items) == brute(docs, items)


def test_edges(spark, edge_docs, edge_rows):
    docs = [(r[0], r[1]) for r in edge_rows]
    items = [(1, None), (2, ""), (3, "!!!"), (4, "nowhere zzzzz"), (5, "THE of the"), (5, "naïve 12"), (None, "the rest")]
    index = rs.build_index(edge_docs.withColumnRenamed("value", "sketch"))
    table = spark.createDataFrame([(i, t, 0.5) for i, t in items], "item_id long, text string, score double")
    got = sorted(map(tuple, rs.search(index, table).collect()), key=str)
    assert got == brute(docs, items)


def test_empty_tables(spark, no_docs):
    items = [(1, "the")]
    assert answer(spark, [], items) == []
    assert answer(spark, [(1, "the"), (2, "a")], []) == []
    assert answer(spark, [(1, None), (2, "  ")], items) == []


def test_the_bound_is_never_below_the_score():
    chance = random.Random(3)
    words = [f"w{i}".encode() for i in range(200)]
    counts = [Counter(chance.choices(words, k=chance.randint(1, 300))) for _ in range(50)]
    total = sum(c.total() for c in counts)
    block = rs.Block([0, 1], words, rs.np.arange(1, 201), [rs.np.arange(0, 90), rs.np.arange(40, 200)])
    sketches = [rs.sketch(c, rs.length_norm(c.total(), 50, total), rs.Hashes()) for c in counts]
    scorer = rs.Scorer(block, 50, total)
    for places, bounds in rs.Bounds(block)(sketches):
        for i, bound in zip(places, bounds, strict=True):
            gains = scorer.gains(b" ".join(counts[i].elements()))
            for j in (0, 1):
                assert scorer.score(gains, j) <= bound[j]


def test_every_document_with_a_term_has_a_sketch(spark, sf_dir):
    index = rs.build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = index.rows.filter("length(sketch) % 2 = 0 AND length(sketch) BETWEEN 64 AND 4096").count()
    assert n == index.documents == index.rows.count()
    index.drop()


def test_query_equals_its_sql(spark, sf_dir):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    expected = duck.execute(ORACLE["op13_ranked_search"]).fetchall()
    got = [tuple(r) for r in QUERIES["op13_ranked_search"](spark, sf_dir).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got) == sorted(expected) and len(got) > 100
