import hashlib
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from headingflow.llm.mixing import mix
from headingflow.llm.queries import MIX_WEIGHTS, ORACLE, QUERIES, domain_sql, mixed, op4_mixing, token_digests


def shared_out(budget, children):
    """Children ``name: (weight, capacity)``; the full ones first, the rest by weight."""
    grants, left, open_children = {}, budget, dict(children)
    while True:
        weight = sum(w for w, _ in open_children.values())
        full = {n: c for n, (w, c) in open_children.items() if c * weight <= w * left}
        if not full:
            break
        # The one that is full first.
        name = min(full, key=lambda n: (full[n] / open_children[n][0], n))
        grants[name] = full[name]
        left -= full[name]
        del open_children[name]
    weight = sum(w for w, _ in open_children.values())
    grants |= {n: min(c, w * left // weight) for n, (w, c) in open_children.items()}
    return grants


def brute_mix(rows, weights, share, epochs, seed):
    """``copies`` of ``(id, path, tokens)``."""
    leaves = Counter()
    for _, path, tokens in rows:
        leaves[path] += tokens
    names = ["domain", "lang", "source"]
    weight = {(level, name): w for level, name, w in weights}

    def deal(prefix, budget):
        depth = len(prefix)
        if depth == 3:
            return {prefix: budget}
        children = {
            p[depth]: (
                weight.get((names[depth], p[depth]), 1),
                epochs * sum(t for q, t in leaves.items() if q[: depth + 1] == p[: depth + 1]),
            )
            for p in leaves
            if p[:depth] == prefix
        }
        dealt = {}
        for name, grant in shared_out(budget, children).items():
            dealt |= deal((*prefix, name), grant)
        return dealt

    total = sum(leaves.values())
    grants = deal((), min(int(total * share), total * epochs))
    copies = []
    for path, grant in grants.items():
        whole, rest = divmod(grant, leaves[path]) if leaves[path] else (0, 0)
        keyed = defaultdict(list)
        for key, p, tokens in rows:
            if p == path:
                code = hashlib.md5(":".join([str(seed), str(whole + 1), *([] if key is None else [str(key)])]).encode())
                keyed[code.hexdigest()].append((key, tokens))
        used = 0
        for code in sorted(keyed):
            used += sum(t for _, t in keyed[code])
            copies += [(key, whole + (used <= rest)) for key, _ in keyed[code]]
    return Counter(copies)


@pytest.mark.parametrize("share, epochs", [(1.0, 4), (0.3, 1), (2.5, 3), (9.0, 2), (0.0, 4)])
def test_mix_equals_brute_force(spark, share, epochs):
    rows = [
        (i if i % 31 else None, (f"d{i % 3}", f"l{i % 2}" if i % 7 else "", f"s{i % 5}" if i % 2 else "s0"), i * 37 % 90)
        for i in range(300)
    ]
    rows += rows[:20]
    weights = [("domain", "d0", 7), ("domain", "d1", 2), ("lang", "l0", 3), ("source", "s3", 5)]
    table = spark.createDataFrame([(k, *p, n, "x") for k, p, n in rows], "doc_id long, a string, b string, c string, n long, domain string")
    table = table.withColumn("b", F.when(F.col("b") != "", F.col("b"))).repartition(3)
    found = mix(
        table,
        spark.createDataFrame(weights, "level string, name string, weight int"),
        {"domain": F.col("a"), "lang": F.col("b"), "source": F.col("c")},
        F.col("n"),
        share=share,
        epochs=epochs,
        seed=3,
    )
    assert found.columns == [*table.columns, "copies"]
    assert Counter((r.doc_id, r.copies) for r in found.collect()) == brute_mix(rows, weights, share, epochs, 3)


def test_mix_of_edge_cases(edge_docs, edge_rows, no_docs):
    found = mixed(edge_docs).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in edge_rows)
    assert all(r.copies >= 0 and r.domain in (None, "x") for r in found)
    assert mixed(no_docs).collect() == []


def test_mix_equals_its_sql(spark, sf_dir):
    link = duckdb.connect()
    link.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = sorted(link.execute(ORACLE["op4_mixing"]).fetchall())
    assert sorted(map(tuple, op4_mixing(spark, sf_dir).collect())) == expected


def test_stages_in_order_with_the_columns_of_documents(spark, sf_dir):
    """Each stage against its operator, on all that the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "near_deduplication", "decontamination", "source_mixing", "token_output"]
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:4]:
        made = stage(spark, kept[-1], sf_dir)
        assert made.dtypes == docs.dtypes
        kept.append(spark.createDataFrame(made.collect(), docs.schema))
    rows = [Counter(map(tuple, k.collect())) for k in kept]
    judged = {r.doc_id for r in QUERIES["op1_quality_classifier"](spark, sf_dir).collect() if r.kept}
    assert {r[0] for r in rows[1]} == judged
    assert rows[2] <= rows[1] and rows[3] <= rows[2]
    benchmark = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {r[0] for r in rows[2] if any(b in r[1] for b in benchmark)}
    assert leaks and leaks == {r[0] for r in rows[2] - rows[3]}
    copies = {r.doc_id: r["copies"] for r in mixed(kept[3]).collect()}
    assert {r[0]: n for r, n in rows[4].items()} == {k: n for k, n in copies.items() if n}
    digests = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in digests) == Counter(
        {k: n for k, n in copies.items() if n}
    )


def test_stages_take_edge_cases(spark, sf_dir, edge_docs, no_docs):
    for table in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, table, sf_dir)
            rows = made.collect()
            assert name == "token_output" or made.columns == table.columns
            assert rows or table is no_docs or name == "quality_classifier"


def test_digests_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b")] * 3 + [(2, None)], "doc_id long, text string")
    found = sorted(map(tuple, token_digests(docs).select("doc_id", "start", "n_tokens").collect()))
    assert found == [(1, 0, 3), (1, 3, 3), (1, 6, 3), (2, 9, 1)]


def test_domains_come_from_the_source(spark):
    rows = spark.createDataFrame([("src0",), ("src1",), ("src5",), ("none",), (None,)], "source string")
    found = [r[0] for r in rows.select(F.expr(domain_sql("try_cast"))).collect()]
    assert found == ["forum", "news", "wiki", "forum", "forum"]
    assert {w[1] for w in MIX_WEIGHTS if w[0] == "domain"} == {"forum", "news", "wiki"}
