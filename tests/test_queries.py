"""Every registered query against its SQL, on the smallest tables."""

import datetime

import duckdb
import pytest

from parcelspark.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def _plain(v):
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else repr(v) if isinstance(v, float) else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    found = duck.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, found.fetchall())


def test_queries_without_sql_run(spark):
    for name in set(registry.queries()) - set(registry.oracle_sql()):
        assert registry.queries()[name](spark, DATA).count() > 0


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.queries()) <= set(__spark_entry__.queries())


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{DATA}/orders.parquet")
    plan = registry.queries()["keep_filter"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in plan and len(df.columns) == 6
    box = spark.read.parquet(f"{DATA}/lineitem.parquet").where("l_quantity > 49").select("l_orderkey")
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,49.0)]" in box._jdf.queryExecution().executedPlan().toString()


def test_grid_join_is_a_hash_or_merge_join_and_finds_all_pairs(spark):
    from parcelspark.operators import joins

    rows = [(i, (i * 37) % 90, (i * 53) % 90, (i * 37) % 90 + 1 + i % 13, (i * 53) % 90 + 1 + i % 7) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x0 long, y0 long, x1 long, y1 long")
    pairs = joins.self_pairs(df, 10)
    assert "CartesianProduct" not in pairs._jdf.queryExecution().executedPlan().toString() and "NestedLoop" not in pairs._jdf.queryExecution().executedPlan().toString()
    got = sorted((r[0], r[1]) for r in pairs.select("a.id", "b.id").collect())
    want = sorted((p[0], q[0]) for p in rows for q in rows if p[0] < q[0] and p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2])
    assert got == want


def test_attribute_join_refuses_repeated_keys(spark):
    from parcelspark.operators import joins

    df = spark.createDataFrame([(1,), (2,)], "id int")
    with pytest.raises(ValueError):
        joins.join_attributes(df, spark.createDataFrame([(1, 2), (1, 3)], "id int, v int"), ["id"])
    with pytest.raises(ValueError):
        joins.upsert_partition(spark.createDataFrame([(1, 1), (1, 2)], "k int, v int"), spark.createDataFrame([(1, 9)], "k int, v int"), "k")


def test_components_of_chains_hubs_and_nothing(spark):
    from parcelspark.operators.graph import connected_components

    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (500, 400)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 160)} == {100} and got[500] == got[400] == 400
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
