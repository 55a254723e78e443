"""Every query on the smallest tables against its SQL."""

import math

import duckdb
import pytest

from attestra.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, oracle, name):
    got = registry.queries()[name](spark, SF)
    cols = sorted(got.columns)
    rows = sorted(([plain(r[c]) for c in cols] for r in got.collect()), key=repr)
    cur = oracle.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(([plain(r[names.index(c)]) for c in cols] for r in cur.fetchall()), key=repr)
    assert rows == want


def test_rest_of_the_queries_run(spark):
    for name in set(registry.queries()) - set(registry.oracle_sql()):
        assert registry.queries()[name](spark, SF).count() >= 0


def test_big_sides_are_not_broadcast_blindly(spark):
    plan = registry.queries()["contradictory_measurements"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry():
    import __spark_entry__ as e

    assert {"coverage_by_node", "strongest_projection", "reconcile_snapshot"} <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
