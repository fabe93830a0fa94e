import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = sorted(n for n in entry.oracle_sql() if not n.startswith("op"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("events", "documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(str(float(r[i])) if isinstance(r[i], float) else str(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    found = entry.queries()[name](spark, SF)
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert rows(found.columns, [tuple(r) for r in found.collect()]) == rows(names, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
