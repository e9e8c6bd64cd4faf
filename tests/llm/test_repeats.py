import random
import re
from collections import Counter

import duckdb
import pytest

from headingflow.llm import repeats as rp
from headingflow.llm.queries import ORACLE, QUERIES


def brute(docs, window):
    texts = [(d, re.findall("[^\x20\x09-\x0d]+", t or "")) for d, t in docs]
    seen = Counter(tuple(w[i : i + window]) for _, w in texts for i in range(len(w) - window + 1))
    rows = []
    for d, words in texts:
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        rows.append((d, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(rows, key=str)


def corpus(seed, window):
    """Copies, near copies, shared passages, passages at borders, repeats inside a text, and chance repeats."""
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(500)]

    def text(n):
        return [chance.choice(words) for _ in range(n)]

    base = [text(chance.randint(0, 6 * window)) for _ in range(40)]
    docs = [list(b) for b in base]
    docs += [list(chance.choice(base)) for _ in range(15)]
    for _ in range(30):
        edited = list(chance.choice(base))
        for _ in range(chance.randint(1, 3)):
            if edited:
                edited[chance.randrange(len(edited))] = "edit" + str(chance.random())
        docs.append(edited)
    passage = text(window + 5)
    for n in (window - 1, window, window + 5):
        for _ in range(20):
            docs.append(text(chance.randint(0, window)) + passage[:n] + text(chance.randint(0, window)))
    docs.append(passage + text(3) + passage + passage)
    docs.append(["a"] * (3 * window))
    docs.append((["a", "b"] * window)[: window + 1])
    docs.append(text(window - 1) * 3)
    return [(i, chance.choice([" ", "\n", "\t  "]).join(d)) for i, d in enumerate(docs)]


@pytest.mark.parametrize(("seed", "window", "gram"), [(1, 8, 3), (2, 12, 12), (3, 35, 12)])
def test_equals_brute_force(spark, monkeypatch, seed, window, gram):
    monkeypatch.setattr(rp, "SECTION_BITS", 5)  # references of 32 words
    monkeypatch.setattr(rp, "RUN", 200)
    monkeypatch.setattr(rp, "HOT", 30)  # passages are joined by broadcast
    docs = corpus(seed, window)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = rp.remove_repeats(table, window=window, gram=gram, shard_words=300, stream_words=200)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, window)


def test_long_texts_in_slices(spark, monkeypatch):
    words = [f"w{i % 977}x{i % 31}" for i in range(5000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[2000:2100])), (3, " ".join(words[4960:])), (4, "w1")]
    parts = [list(x) for x in rp._slices([d[1].encode().split() for d in docs], 35)]
    monkeypatch.setattr(rp, "SLICE", 64)
    monkeypatch.setattr(rp, "RUN", 64)
    assert len(list(rp._slices([d[1].encode().split() for d in docs], 35))) > 10 * len(parts)
    made = rp.Windows([w.encode().split() for _, w in docs], 35, 12)
    assert len(made.starts) == 5000 - 34 + 66 + 6

    def places():
        found = set()
        for numbers, offsets, texts in rp._slices([d[1].encode().split() for d in docs], 35):
            own = rp.Windows(texts, 35, 12)
            for s in own.starts:
                i = own.owner[s]
                place = (numbers[i], int(s - own.begins[i]) + offsets[i])
                assert place not in found
                found.add(place)
        return found

    assert len(places()) == len(made.starts)


def test_edges(spark, edge_docs, edge_rows):
    docs = [(r[0], r[1]) for r in edge_rows]
    got = rp.remove_repeats(edge_docs.withColumnRenamed("digest", "key"), window=10, gram=4)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, 10)


def test_empty_table(spark, no_docs):
    assert rp.remove_repeats(no_docs).count() == 0


def test_states_tell_windows():
    chance = random.Random(5)
    texts = [[chance.choice([b"a", b"b", b"c"]) for _ in range(60)] for _ in range(4)]
    automaton = rp.Automaton(texts[:2], 4)
    inside = {tuple(t[i : i + 4]) for t in texts[:2] for i in range(57)}
    state_of = {}
    for t in texts:
        for i, state in enumerate(automaton.states(t)):
            assert (state >= 0) == (tuple(t[i : i + 4]) in inside)
            if state >= 0:
                assert state_of.setdefault(tuple(t[i : i + 4]), state) == state
    assert len(set(state_of.values())) == len(state_of) == len(inside)


def test_query_equals_its_sql(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = sorted(duck.execute(ORACLE["op11_repeated_passages"]).fetchall())
    got = QUERIES["op11_repeated_passages"](spark, sf_dir).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == expected and any(r[2] for r in expected)
