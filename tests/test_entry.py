import math

import duckdb
import pytest

import __spark_entry__ as registry
from headingflow.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def ordered(rows):
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


def test_every_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(set(registry.oracle_sql()) & set(QUERIES)))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    result = registry.queries()[name](spark, sf_dir)
    answer = duck.execute(registry.oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in answer.description}
    assert {n: TYPES[k] for n, k in result.dtypes} == kinds
    names = sorted(result.columns)
    theirs = [dict(zip(kinds, row)) for row in answer.fetchall()]
    assert ordered([row[n] for n in names] for row in result.collect()) == ordered(
        [row[n] for n in names] for row in theirs
    )


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(registry.oracle_sql())))
def test_model_queries_give_rows(spark, sf_dir, name):
    assert not registry.queries()[name](spark, sf_dir).isEmpty()


def test_entry(spark):
    assert registry.entry(spark).count() == 37
