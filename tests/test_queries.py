"""Every registered query of the reference operators against its SQL in DuckDB."""

import math

import duckdb
import pytest
from conftest import SF

from tablewright import queries as q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    if isinstance(v, bool):
        return v
    return round(float(v), 6) if isinstance(v, int | float) or hasattr(v, "as_tuple") else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = q.QUERIES[name](spark, SF)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    if name in q.ORACLE:
        rel = duck.execute(q.ORACLE[name])
        names = [c[0] for c in rel.description]
        assert sorted(names) == sorted(df.columns)
        assert rows(names, rel.fetchall()) == mine
    else:
        assert mine


@pytest.mark.parametrize(
    ("values", "n"),
    [
        ("(0, 'P', 1.5, '2000-07-01'), (1, 'F', 2.5, '2000-11-01')", 3),
        ("(5, 'P', 2.5, '2000-11-01'), (-5, 'O', null, '2001-01-01'), (7, 'P', 3.5, null), (-7, 'F', 4.5, '2000-07-02'), (-9, 'P', null, '2000-07-03'), (1, null, 5.5, '2000-07-04')", 9),
        ("(3, 'F', 1.5, '2000-07-01'), (3, 'O', 2.5, '2000-11-01'), (3, null, 3.5, '2000-12-01'), (3, 'P', 4.5, '2000-12-02'), (null, 'O', 5.5, null), (4, 'O', 6.5, '2000-07-04'), (4, 'O', 6.5, '2000-07-04')", 8),
    ],
    ids=["zero", "of_other_orders", "repeated"],
)
def test_merged_orders_whose_key_is_taken(spark, tmp_path, values, n):
    """Order 0 has its own key when negated, 5 and 7 have those of other orders: their reversals are still rows beside these. An update by key 3 is one of its finished order only."""
    con = duckdb.connect()
    con.execute(f"copy (select k::bigint as o_orderkey, s as o_orderstatus, p::double as o_totalprice, d::timestamp as o_orderdate from (values {values}) v(k, s, p, d)) to '{tmp_path}/orders.parquet'")
    con.execute(f"create view orders as select * from '{tmp_path}/orders.parquet'")
    df = q.QUERIES["write_merge"](spark, str(tmp_path))
    rel = con.execute(q.ORACLE["write_merge"])
    names = [c[0] for c in rel.description]
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    assert names == df.columns and len(mine) == n and rows(names, rel.fetchall()) == mine


def test_filters_reach_the_scan(spark, capsys):
    q.QUERIES["watermark_filter"](spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan
    q.QUERIES["scan_prune"](spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan
