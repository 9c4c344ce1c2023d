"""The registered queries over the driver's tables, each beside SQL that gives the same rows.

Most are plans; the rest call an operator on its own. Sums of money are taken in
decimals, so that they don't depend on the order of rows.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import checks, cleaning
from tablewright.operators import incremental, measures, merge, stages, views
from tablewright.plans import registry
from tablewright.plans.compiler import PlanBuilder, compiled
from tablewright.plans.config import YamlConfigProvider
from tablewright.plans.config import table as plan_from
from tablewright.plans.writer import SnapshotStore, TableWriter
from tablewright.sources import ingest, profiling, readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plan_query(name: str, plan: dict, sql: str | None) -> None:
    """Register a plan whose sources are tables by name, or by {name: table}."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sources = [{"name": s, "path": f"{sf_dir}/{s}.parquet"} if isinstance(s, str) else s if "generated" in s else {k: v for k, v in s.items() if k != "of"} | {"path": f"{sf_dir}/{s['of']}.parquet"} for s in plan["sources"]]
        return compiled(spark, plan | {"name": name, "sources": sources})

    QUERIES[name] = run
    if sql:
        ORACLE[name] = sql


def query(name: str, sql: str | None = None) -> Callable:
    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


def cols(**named: str) -> list[dict]:
    """Columns from name=expression."""
    return [{"name": n, "inputs": [{"expression": e}]} for n, e in named.items()]


def one(sources: list, **stage: object) -> dict:
    return {"sources": sources, "stages": [{"name": "only"} | stage]}


MONEY = "sum(cast({} as decimal(18,2)))"


def money(column: str, alias: str, **more: object) -> dict:
    return {"function": "sum", "expression": f"cast({column} as decimal(18,2))", "alias": alias} | more


# --- scans, projection, filters ---------------------------------------------------

FLAGSHIP = {
    "sources": ["orders", "customer"],
    "stages": [
        {
            "name": "joined",
            "joins": [{"source": "customer", "type": "inner", "conditions": [{"left": "orders.o_custkey", "right": "c_custkey"}]}],
            "columns": cols(segment="customer.c_mktsegment", status="orders.o_orderstatus", price="cast(orders.o_totalprice as decimal(18,2))"),
        },
        {"name": "summed", "group_by": {"keys": ["segment", "status"], "aggregations": [{"function": "sum", "column": "price", "alias": "revenue"}, {"function": "count", "column": "*", "alias": "n_orders"}], "having": ["n_orders > 5"]}},
        {"name": "shown", "columns": cols(segment="segment", status="status", revenue="cast(revenue as double)", n_orders="n_orders")},
    ],
}
plan_query("flagship_segment_revenue", FLAGSHIP, """
    select c_mktsegment as segment, o_orderstatus as status, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as revenue, count(*) as n_orders
    from orders join customer on o_custkey = c_custkey group by 1, 2 having count(*) > 5""")  # fmt: skip
plan_query("scan_prune", one(["orders"], columns=cols(o_orderkey="orders.o_orderkey", o_orderstatus="orders.o_orderstatus")), "select o_orderkey, o_orderstatus from orders")
plan_query(
    "filter_complex",
    one(["orders"], columns=cols(k="orders.o_orderkey", s="orders.o_orderstatus", p="orders.o_totalprice", pr="orders.o_orderpriority"), filters=["s in ('F', 'O') and not (p between 1000 and 50000)", "pr like '%-%' and pr rlike '^[1-3]'", "s <=> 'F' or p > 100000"]),
    "select o_orderkey as k, o_orderstatus as s, o_totalprice as p, o_orderpriority as pr from orders where o_orderstatus in ('F','O') and not (o_totalprice between 1000 and 50000) and o_orderpriority like '%-%' and regexp_matches(o_orderpriority, '^[1-3]') and (o_orderstatus = 'F' or o_totalprice > 100000)",
)
plan_query(
    "source_filters",
    {"sources": ["orders", "customer"], "stages": [{"name": "a", "source_filters": {"customer": ["c_mktsegment = 'BUILDING'"], "orders": "o_orderstatus = 'O'"}, "joins": [{"source": "customer", "type": "left", "conditions": [{"left": "o_custkey", "right": "c_custkey"}]}], "columns": cols(k="orders.o_orderkey", seg="customer.c_mktsegment")}]},
    "select o_orderkey as k, c_mktsegment as seg from (select * from orders where o_orderstatus = 'O') left join (select * from customer where c_mktsegment = 'BUILDING') on o_custkey = c_custkey",
)
plan_query(
    "project_cast_default",
    one(["customer"], columns=[
        {"name": "id", "data_type": "int", "inputs": [{"source": "customer", "column": "c_custkey"}]},
        {"name": "balance", "data_type": "decimal(12,1)", "inputs": [{"column": "c_acctbal"}]},
        {"name": "bad", "data_type": "int", "default": -1, "inputs": [{"expression": "nullif(c_mktsegment, 'BUILDING')"}]},
        {"name": "segment", "default": "none", "inputs": [{"expression": "nullif(c_mktsegment, 'BUILDING')"}]},
        {"name": "constant", "data_type": "bigint", "default": 7},
    ]),
    "select cast(c_custkey as int) as id, cast(c_acctbal as decimal(12,1)) as balance, try_cast(coalesce(nullif(c_mktsegment, 'BUILDING'), '-1') as int) as bad, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') as segment, cast(7 as bigint) as constant from customer",
)
plan_query("multi_input_concat", one(["customer"], columns=[{"name": "k", "inputs": [{"column": "c_mktsegment"}, {"expression": "nullif(c_nationkey, 3)"}, {"column": "c_name"}]}, {"name": "d", "delimiter": "-", "inputs": [{"column": "c_custkey"}, {"column": "c_nationkey"}]}]), "select concat_ws('||', c_mktsegment, cast(nullif(c_nationkey, 3) as varchar), c_name) as k, concat_ws('-', cast(c_custkey as varchar), cast(c_nationkey as varchar)) as d from customer")
plan_query("stage_chain", {"sources": ["lineitem"], "stages": [{"name": "a", "columns": cols(k="lineitem.l_orderkey", q="cast(lineitem.l_quantity as int)")}, {"name": "b", "columns": cols(k="k", q2="q * 2"), "filters": ["q2 > 40"]}, {"name": "c", "group_by": {"keys": ["k"], "aggregations": [{"function": "sum", "column": "q2"}]}}]}, "select l_orderkey as k, cast(sum(cast(l_quantity as int) * 2) as bigint) as sum_q2 from lineitem where cast(l_quantity as int) * 2 > 40 group by 1")
plan_query("generated_rows", {"sources": [{"name": "g", "generated": {"row_count": 5}}], "stages": [{"name": "a", "columns": cols(id="_generated_row_id", word="concat('r', _generated_row_id)")}]}, "select range as id, 'r' || range as word from range(5)")

# --- joins ------------------------------------------------------------------------

for _kind in ("inner", "left", "right", "full"):
    plan_query(
        f"join_{_kind}",
        {"sources": ["customer", {"name": "s", "of": "supplier"}], "stages": [{"name": "a", "source_filters": {"customer": ["c_mktsegment <> 'MACHINERY'"], "s": ["s_acctbal > 0"]}, "joins": [{"source": "s", "type": _kind, "conditions": [{"left": "customer.c_custkey", "right": "s_suppkey"}]}], "columns": cols(c="customer.c_custkey", s="s.s_suppkey", name="coalesce(customer.c_name, s.s_name)")}]},
        f"select c_custkey as c, s_suppkey as s, coalesce(c_name, s_name) as name from (select * from customer where c_mktsegment <> 'MACHINERY') {_kind} join (select * from supplier where s_acctbal > 0) on c_custkey = s_suppkey",
    )
plan_query(
    "join_duplicates_keep_left",
    {"sources": ["nation", {"name": "other", "of": "nation"}], "stages": [{"name": "a", "joins": [{"source": "other", "type": "left", "conditions": [{"left": "n_regionkey", "right": "n_nationkey"}]}]}]},
    "select a.n_nationkey, a.n_name, a.n_regionkey from nation a left join nation b on a.n_regionkey = b.n_nationkey",
)


@query("join_computed_keys", "select c_custkey as c, upper('n' || c_nationkey || '-' || c_mktsegment) as place, n_name as nation from customer left join nation on upper('n' || c_nationkey) = 'N' || n_nationkey")
def _computed(spark, d):
    stages_ = [
        {"name": "keys", "columns": cols(c="customer.c_custkey", place="upper(concat('n', customer.c_nationkey, '-', customer.c_mktsegment))", code="upper(concat('n', customer.c_nationkey))")},
        {"name": "found", "joins": [{"source": "nations", "type": "left", "conditions": [{"left": "code", "right": "nation_code"}]}], "columns": cols(c="c", place="place", nation="nations.nation")},
    ]
    nations = table(spark, d, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("nation_code"), F.col("n_name").alias("nation"))
    return compiled(spark, {"name": "computed", "sources": [{"name": "customer", "path": f"{d}/customer.parquet"}], "stages": stages_}, {"customer": table(spark, d, "customer"), "nations": nations})


plan_query("join_cross", {"sources": ["nation", "region"], "stages": [{"name": "a", "joins": [{"source": "region", "type": "cross"}], "columns": cols(n="nation.n_name", r="region.r_name")}]}, "select n_name as n, r_name as r from nation cross join region")
plan_query("join_theta", {"sources": ["nation", "region"], "stages": [{"name": "a", "joins": [{"source": "region", "type": "inner", "conditions": [{"left": "n_regionkey", "right": "r_regionkey", "operator": "<"}, {"left": "n_nationkey", "right": "r_regionkey", "operator": "!="}]}], "columns": cols(n="nation.n_name", r="region.r_name")}]}, "select n_name as n, r_name as r from nation join region on n_regionkey < r_regionkey and n_nationkey <> r_regionkey")
plan_query(
    "join_multi",
    {"sources": ["lineitem", "orders", "customer", "nation", {"name": "region", "of": "region", "broadcast": True}], "stages": [{"name": "a", "joins": [
        {"source": "orders", "type": "inner", "conditions": [{"left": "lineitem.l_orderkey", "right": "o_orderkey"}]}, {"source": "customer", "type": "inner", "conditions": [{"left": "orders.o_custkey", "right": "c_custkey"}]},
        {"source": "nation", "type": "inner", "broadcast": True, "conditions": [{"left": "customer.c_nationkey", "right": "n_nationkey"}]}, {"source": "region", "type": "inner", "conditions": [{"left": "nation.n_regionkey", "right": "r_regionkey"}]},
    ], "columns": cols(region="region.r_name", price="cast(lineitem.l_extendedprice as decimal(18,2))")}, {"name": "b", "group_by": {"keys": ["region"], "aggregations": [{"function": "sum", "column": "price", "alias": "total"}, {"function": "count", "column": "price", "alias": "n"}]}}, {"name": "c", "columns": cols(region="region", total="cast(total as double)", n="n")}]},
    "select r_name as region, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as total, count(*) as n from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1",
)
plan_query(
    "join_self_twice",
    {"sources": ["customer", "supplier", "nation"], "stages": [{"name": "a", "joins": [
        {"source": "supplier", "type": "inner", "conditions": [{"left": "customer.c_custkey", "right": "s_suppkey"}]}, {"source": "nation", "alias": "cn", "type": "left", "conditions": [{"left": "customer.c_nationkey", "right": "n_nationkey"}]}, {"source": "nation", "alias": "sn", "type": "left", "conditions": [{"left": "supplier.s_nationkey", "right": "n_nationkey"}]},
    ], "columns": cols(k="customer.c_custkey", c="cn.n_name", s="sn.n_name")}]},
    "select c_custkey as k, a.n_name as c, b.n_name as s from customer join supplier on c_custkey = s_suppkey left join nation a on c_nationkey = a.n_nationkey left join nation b on s_nationkey = b.n_nationkey",
)
plan_query(
    "join_alias_dup",
    {"sources": ["nation", {"name": "other", "of": "nation"}], "stages": [{"name": "a", "joins": [{"source": "other", "alias": "o", "type": "left", "conditions": [{"left": "nation.n_regionkey", "right": "n_nationkey"}]}], "columns": cols(n="nation.n_name", m="o.n_name")}]},
    "select a.n_name as n, b.n_name as m from nation a left join nation b on a.n_regionkey = b.n_nationkey",
)
plan_query(
    "join_dedupe",
    {"sources": ["customer", "orders"], "stages": [{"name": "a", "joins": [{"source": "orders", "type": "left", "conditions": [{"left": "c_custkey", "right": "o_custkey"}], "dedupe_by": ["o_custkey"], "dedupe_order_by": "o_orderkey"}], "columns": cols(c="customer.c_custkey", last_order="orders.o_orderkey")}]},
    "select c_custkey as c, max(o_orderkey) as last_order from customer left join orders on c_custkey = o_custkey group by 1",
)
plan_query(
    "join_range",
    {"sources": ["lineitem", "orders"], "stages": [{"name": "a", "joins": [{"source": "orders", "type": "inner", "conditions": [{"left": "l_orderkey", "right": "o_orderkey"}, {"left": "l_shipdate", "right": "o_orderdate", "operator": ">"}]}], "columns": cols(k="lineitem.l_orderkey", line="lineitem.l_linenumber", part="lineitem.l_partkey", status="orders.o_orderstatus"), "filters": []}]},
    "select l_orderkey as k, l_linenumber as line, l_partkey as part, o_orderstatus as status from lineitem join orders on l_orderkey = o_orderkey and l_shipdate > o_orderdate",
)


@query("join_semi", "select c_custkey, c_name from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 100000)")
def _semi(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").filter("o_totalprice > 100000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("join_anti", "select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def _anti(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


# --- aggregation ------------------------------------------------------------------

plan_query(
    "agg_basic",
    {"sources": ["lineitem"], "stages": [{"name": "a", "columns": cols(f="l_returnflag", s="l_linestatus", q="cast(l_quantity as int)", p="cast(l_extendedprice as decimal(18,2))"), "filters": []}, {"name": "b", "group_by": {"keys": ["f", "s"], "aggregations": [{"function": "sum", "column": "q"}, {"function": "avg", "column": "q"}, {"function": "min", "column": "q"}, {"function": "max", "column": "q"}, {"function": "count", "column": "q"}, {"function": "sum", "column": "p"}]}}, {"name": "c", "columns": cols(f="f", s="s", sum_q="sum_q", avg_q="round(avg_q, 6)", min_q="min_q", max_q="max_q", count_q="count_q", sum_p="cast(sum_p as double)")}]},
    "select l_returnflag as f, l_linestatus as s, cast(sum(cast(l_quantity as int)) as bigint) as sum_q, round(avg(cast(l_quantity as int)), 6) as avg_q, min(cast(l_quantity as int)) as min_q, max(cast(l_quantity as int)) as max_q, count(*) as count_q, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as sum_p from lineitem group by 1, 2",
)
_STATS = ["stddev", "stddev_pop", "stddev_samp", "variance", "var_pop", "var_samp", "mean"]
plan_query(
    "agg_stats",
    {"sources": ["lineitem"], "stages": [{"name": "b", "group_by": {"keys": ["l_returnflag"], "aggregations": [{"function": f, "column": "l_quantity", "alias": f} for f in _STATS]}}, {"name": "c", "columns": cols(l_returnflag="l_returnflag", **{f: f"round({f}, 6)" for f in _STATS})}]},
    "select l_returnflag, " + ", ".join(f"round({'avg' if f == 'mean' else f}(l_quantity), 6) as {f}" for f in _STATS) + " from lineitem group by 1",
)
plan_query(
    "agg_distinct",
    {"sources": ["lineitem"], "stages": [{"name": "b", "group_by": {"keys": ["l_returnflag"], "aggregations": [{"function": "count", "column": "l_suppkey", "distinct": True, "alias": "suppliers"}, {"function": "sum", "column": "l_linenumber", "distinct": True, "alias": "lines"}, {"function": "avg", "column": "l_linenumber", "distinct": True, "alias": "mean_line"}, {"function": "count_distinct", "column": "l_partkey", "alias": "parts"}]}}]},
    "select l_returnflag, count(distinct l_suppkey) as suppliers, cast(sum(distinct l_linenumber) as bigint) as lines, avg(distinct l_linenumber) as mean_line, count(distinct l_partkey) as parts from lineitem group by 1",
)
plan_query(
    "agg_collect",
    {"sources": ["nation"], "stages": [{"name": "b", "group_by": {"keys": ["n_regionkey"], "aggregations": [{"function": "collect_list", "column": "n_name", "alias": "names"}, {"function": "collect_set", "column": "n_regionkey", "alias": "keys"}]}}, {"name": "c", "columns": cols(n_regionkey="n_regionkey", names="concat_ws(',', array_sort(names))", n_keys="size(keys)")}]},
    "select n_regionkey, string_agg(n_name, ',' order by n_name) as names, 1 as n_keys from nation group by 1",
)
plan_query(
    "agg_expression",
    {"sources": ["lineitem"], "stages": [{"name": "b", "group_by": {"keys": ["l_linestatus"], "aggregations": [{"function": "sum", "expression": "cast(l_extendedprice as decimal(12,2)) * cast(1 - l_discount as decimal(4,2))", "alias": "net"}]}}, {"name": "c", "columns": cols(l_linestatus="l_linestatus", net="cast(net as double)")}]},
    "select l_linestatus, cast(sum(cast(l_extendedprice as decimal(12,2)) * cast(1 - l_discount as decimal(4,2))) as double) as net from lineitem group by 1",
)
plan_query("agg_default_alias", one(["orders"], group_by={"keys": ["o_orderstatus"], "aggregations": [{"function": "count", "column": "o_orderkey"}, {"function": "max", "column": "orders.o_orderkey"}]}), "select o_orderstatus, count(o_orderkey) as count_o_orderkey, max(o_orderkey) as max_orders_o_orderkey from orders group by 1")
plan_query("agg_no_aggs", one(["orders"], group_by={"keys": ["o_orderstatus", "o_orderpriority"]}), "select distinct o_orderstatus, o_orderpriority from orders")
plan_query("having", one(["orders"], group_by={"keys": ["o_custkey"], "aggregations": [{"function": "count", "column": "*", "alias": "n"}], "having": ["n > 3", "o_custkey % 2 = 0"]}), "select o_custkey, count(*) as n from orders group by 1 having count(*) > 3 and o_custkey % 2 = 0")


@query("agg_first_last", "select o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) as first_order, arg_max(o_orderkey, (o_orderdate, o_orderkey)) as last_order, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as last_status from orders group by 1")
def _first_last(spark, d):
    """first and last with order_by, which makes them the same on every run."""
    order = ["o_orderdate", "o_orderkey"]
    sums = [{"function": "first", "column": "o_orderkey", "alias": "first_order", "order_by": order}, {"function": "last", "column": "o_orderkey", "alias": "last_order", "order_by": order}, {"function": "last", "column": "o_orderstatus", "alias": "last_status", "order_by": order}]
    return compiled(spark, {"name": "t", "sources": [{"name": "orders", "path": f"{d}/orders.parquet"}], "stages": [{"name": "b", "group_by": {"keys": ["o_custkey"], "aggregations": sums}}]})


plan_query("agg_approx_distinct", {"sources": ["lineitem"], "stages": [{"name": "b", "group_by": {"keys": ["l_returnflag"], "aggregations": [{"function": "approx_count_distinct", "column": "l_partkey", "alias": "parts"}]}}]}, None)

# --- unions -----------------------------------------------------------------------

_TWO = ["customer", "supplier"]
_MAPS = [{"source": "customer", "column_map": {"id": "c_custkey", "name": "c_name", "nation": "c_nationkey", "kind": "'c'"}}, {"source": "supplier", "column_map": {"id": "s_suppkey", "name": "s_name", "nation": "s_nationkey", "kind": "'s'"}}]
_PICK = {"columns": cols(id="id", name="name", nation="nation", kind="kind")}
plan_query("union_column_map", one(_TWO, union={"sources": _MAPS, "allow_missing_columns": True}, **_PICK), "select c_custkey as id, c_name as name, c_nationkey as nation, 'c' as kind from customer union all select s_suppkey, s_name, s_nationkey, 's' from supplier")
plan_query("union_missing", one(_TWO, union={"sources": _MAPS, "allow_missing_columns": True}, columns=cols(id="id", segment="c_mktsegment", balance="s_acctbal")), "select c_custkey as id, c_mktsegment as segment, cast(null as double) as balance from customer union all select s_suppkey, null, s_acctbal from supplier")
plan_query("union_by_name", one(["nation", {"name": "n2", "of": "nation"}], union={"sources": ["nation", "n2"]}), "select n_name, n_nationkey, n_regionkey from nation union all select n_name, n_nationkey, n_regionkey from nation")
plan_query("union_position", one(["region", {"name": "n", "of": "nation"}], union={"mode": "by_position", "sources": ["region", {"source": "r2"}]}) | {"sources": ["region", {"name": "r2", "of": "region"}]}, "select r_regionkey, r_name from region union all select r_regionkey, r_name from region")
plan_query("union_distinct", one(["nation", {"name": "n2", "of": "nation"}], union={"sources": ["nation", "n2"], "distinct": True}), "select n_name, n_nationkey, n_regionkey from nation")
plan_query("union_previous", {"sources": ["region", {"name": "r2", "of": "region"}], "stages": [{"name": "a", "columns": cols(r_regionkey="r_regionkey + 10", r_name="r_name")}, {"name": "b", "union": {"sources": ["_previous", "r2"]}}]}, "select r_name, r_regionkey + 10 as r_regionkey from region union all select r_name, r_regionkey from region")

# --- stage steps ------------------------------------------------------------------

_LINE = ["l_orderkey", "l_linenumber"]
_LINE_COLUMNS = cols(l_orderkey="l_orderkey", l_linenumber="l_linenumber", l_partkey="l_partkey", l_suppkey="l_suppkey", l_quantity="l_quantity", l_extendedprice="l_extendedprice")
plan_query(
    "dedupe_keep_last",
    {"sources": ["lineitem"], "stages": [{"name": "a", "columns": _LINE_COLUMNS, "extensions": {"stage_plugin": "dedupe_keep_last", "partition_by": _LINE, "order_by": ["l_extendedprice"]}}]},
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_extendedprice desc, l_partkey, l_suppkey, l_quantity) = 1",
)
plan_query("distinct_all", {"sources": ["lineitem"], "stages": [{"name": "a", "columns": cols(a="l_returnflag", b="l_linestatus", c="l_linenumber"), "extensions": {"stage_plugin": "distinct"}}]}, "select distinct l_returnflag as a, l_linestatus as b, l_linenumber as c from lineitem")
plan_query("distinct_cols", {"sources": ["lineitem"], "stages": [{"name": "a", "columns": cols(a="l_orderkey", b="l_partkey"), "extensions": {"stage_plugin": "distinct", "columns": ["a"]}}]}, "select l_orderkey as a, min(l_partkey) as b from lineitem group by 1")
plan_query(
    "check_dups_reject",
    {"sources": ["lineitem"], "stages": [{"name": "a", "columns": _LINE_COLUMNS, "extensions": {"stage_plugin": "check_duplicates", "columns": _LINE}}]},
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1",
)


@query("check_dups_report", "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1")
def _dups(spark, d):
    return stages.duplicate_keys(table(spark, d, "lineitem"), _LINE)


@query("duplicate_records_json", """
    select '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}' as _dq_natural_id, '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || ',"l_returnflag":"' || l_returnflag || '"}' as _dq_record,
    't' as _dq_table_name, 'r1' as _dq_run_id, 'l1' as _dq_load_id, 'l_orderkey,l_linenumber' as _dq_natural_keys, timestamp '2024-01-02 03:04:05' as _dq_detected_at
    from lineitem qualify count(*) over (partition by l_orderkey, l_linenumber) > 1""")  # fmt: skip
def _dup_json(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return stages.duplicate_records(rows, _LINE, "t", "r1", "l1", "2024-01-02 03:04:05").withColumn("_dq_detected_at", F.col("_dq_detected_at").cast("timestamp_ntz"))


_EVENT_DAYS = "select event_id, event_type, cast(ts as date) as day, value from events"


def _events(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day"), "ts", "value")


@query("latest_per_period", "select event_id, event_type, cast(cast(ts as date) as varchar) as day from events qualify ts = max(ts) over (partition by event_type, cast(ts as date))")
def _latest(spark, d):
    return stages.latest_per_period(_events(spark, d), ["event_type"], "day", "ts").select("event_id", "event_type", F.col("day").cast("string").alias("day"))


@query("period_sets", "select event_type, string_agg(distinct strftime(ts, '%Y-%m-%d'), ',' order by strftime(ts, '%Y-%m-%d')) as days from events group by 1")
def _sets(spark, d):
    sets = stages.period_sets(_events(spark, d), "day", ["event_type"])
    return sets.groupBy("event_type").agg(F.concat_ws(",", F.array_sort(F.collect_set(F.col("day").cast("string")))).alias("days"))


@query("period_expansion", "select event_id, cast(cast(ts as date) as varchar) as day from events where cast(ts as date) in (select cast(ts as date) from events where event_id > (select max(event_id) - 50 from events))")
def _expansion(spark, d):
    e = _events(spark, d)
    mark = e.agg(F.max("event_id")).first()[0] - 50
    return incremental.touched_periods(e, "event_id", mark, "day").select("event_id", F.col("day").cast("string").alias("day"))


@query("ensure_sentinels", "select p_partkey, p_name, p_size from part union all select -1, 'UNKNOWN', null union all select -2, 'NONE', 0")
def _sentinels(spark, d):
    return stages.ensure_sentinels(table(spark, d, "part").select("p_partkey", "p_name", "p_size"), [{"p_partkey": -1, "p_name": "UNKNOWN"}, {"p_partkey": -2, "p_name": "NONE", "p_size": 0}], "p_partkey")


_FACT = "(select o_orderkey, coalesce(c_custkey, -1) as fk_customer, case when o_orderstatus = 'F' then 'NO_STATUS' else o_orderstatus end as fk_status from orders left join (select * from customer where c_custkey % 5 <> 0) on o_custkey = c_custkey)"


def _fact(spark, d):
    c = table(spark, d, "customer").filter("c_custkey % 5 <> 0")
    return table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", F.coalesce("c_custkey", F.lit(-1)).alias("fk_customer"), F.when(F.col("o_orderstatus") == "F", "NO_STATUS").otherwise(F.col("o_orderstatus")).alias("fk_status"), "o_orderdate")


_CHECKS = [{"column": "fk_customer", "sentinel": -1}, {"column": "fk_status", "sentinel": "NO_STATUS"}]


@query("unresolved_fk_summary", f"select 'fk_customer' as fk_column, '-1' as sentinel, count(*) filter (fk_customer = -1) as unresolved_count, count(*) as total_count, round(100.0 * count(*) filter (fk_customer = -1) / count(*), 2) as unresolved_pct from {_FACT} union all select 'fk_status', 'NO_STATUS', count(*) filter (fk_status = 'NO_STATUS'), count(*), round(100.0 * count(*) filter (fk_status = 'NO_STATUS') / count(*), 2) from {_FACT}")
def _fks(spark, d):
    return stages.unresolved_fks(_fact(spark, d), _CHECKS).withColumn("unresolved_pct", F.col("unresolved_pct").cast("double"))


@query("unresolved_fk_records", f"select o_orderkey, case when fk_customer = -1 and fk_status = 'NO_STATUS' then 2 else 1 end as n_columns from {_FACT} where fk_customer = -1 or fk_status = 'NO_STATUS'")
def _fk_records(spark, d):
    r = stages.unresolved_records(_fact(spark, d), _CHECKS)
    return r.select(F.get_json_object("record", "$.o_orderkey").cast("bigint").alias("o_orderkey"), F.size("fk_columns").alias("n_columns"))


@query("fk_override_dates", f"select 'fk_customer' as fk_column, count(*) as unresolved_count, cast(min(cast(o.o_orderdate as date)) - 1 as varchar) as watermark_override from {_FACT} f join orders o using (o_orderkey) where fk_customer = -1 and cast(o.o_orderdate as date) >= date '2000-10-01' having count(*) > 0")
def _override(spark, d):
    from datetime import date

    out = stages.override_dates(_fact(spark, d), _CHECKS[:1], "o_orderdate", date(2000, 12, 30), 90)
    return out.select("fk_column", "unresolved_count", F.col("watermark_override").cast("string").alias("watermark_override"))


@query("rejected_json", """
    select '{"o_orderkey":' || o_orderkey || '}' as _dq_natural_id, '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}' as _dq_record, 'not allowed' as _dq_rejection_reason,
    'o_orderstatus' as _dq_column_name, 'in_set' as _dq_rule_name, 'orders' as _dq_table_name, 'r1' as _dq_run_id, 'l1' as _dq_load_id, timestamp '2024-01-02 03:04:05' as _dq_rejected_at from orders where o_orderstatus not in ('F', 'O')""")  # fmt: skip
def _rejected(spark, d):
    _, bad = checks.in_set(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderstatus", ["F", "O"])
    out = stages.rejected_records(bad.select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey"], "not allowed", "o_orderstatus", "in_set", "orders", "r1", "l1", "2024-01-02 03:04:05")
    return out.withColumn("_dq_rejected_at", F.col("_dq_rejected_at").cast("timestamp_ntz"))


@query("flow_previous_period", """
    with f as (select user_id, event_type, cast(ts as date) as day, count(*) as n from events group by all), p as (select day, lead(day) over (order by day) as nxt from (select distinct day from f)),
    b as (select user_id, event_type, nxt as day, n from f join p using (day) where nxt is not null)
    select coalesce(f.user_id, b.user_id) as user_id, coalesce(f.event_type, b.event_type) as event_type, cast(coalesce(f.day, b.day) as varchar) as day, coalesce(f.n, 0) as n, b.n as previous_amount, f.n is null as is_lost_key
    from f full join b on f.user_id = b.user_id and f.event_type = b.event_type and f.day = b.day""")  # fmt: skip
def _flow(spark, d):
    f = _events(spark, d).groupBy("user_id", "event_type", "day").agg(F.count("*").alias("n"))
    return stages.previous_period(f, ["user_id", "event_type"], "day", "n").withColumn("day", F.col("day").cast("string"))


@query("delta_load", "select o_custkey, max(o_orderkey) as o_orderkey from orders where o_orderkey > 500 group by 1")
def _delta(spark, d):
    return stages.delta_load(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey", 500)


# --- column transforms ------------------------------------------------------------


def text_query(name: str, source: str, key: str, made: str, made_sql: str, use: Callable, sql: str) -> None:
    """A transform on a text made from a driver table in both dialects; sql refers to it as x."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return table(spark, d, source).select(key, F.expr(made).alias("x")).select(key, use(F.col("x")).alias("y"))

    QUERIES[name] = run
    ORACLE[name] = f"select {key}, {sql} as y from (select {key}, {made_sql} as x from {source})"


_MAIL = "case when c_custkey % 5 = 0 then null when c_custkey % 7 = 0 then c_name else concat(lower(c_mktsegment), '.', c_custkey, '@mail.example') end"
text_query("mask_email", "customer", "c_custkey", _MAIL, _MAIL, cleaning.mask_email, "case when contains(x, '@') then substr(x, 1, 1) || '***@' || split_part(x, '@', 2) else x end")
_AMOUNT = "case when c_custkey % 4 = 0 then concat('£', cast(cast(c_acctbal as decimal(12,2)) as {0})) when c_custkey % 4 = 1 then 'n/a' when c_custkey % 4 = 2 then concat('-1,', cast(100 + c_nationkey as {0}), '.50') else concat(cast(c_custkey as {0}), ' EUR') end"
text_query("clean_decimal", "customer", "c_custkey", _AMOUNT.format("string"), _AMOUNT.format("varchar"), lambda c: cleaning.clean_decimal(c).cast("double"), "cast(try_cast(nullif(regexp_replace(x, '[^0-9.\\-]', '', 'g'), '') as decimal(38,2)) as double)")
_DATE = "case o_orderkey % 8 when 0 then cast(36526 + o_custkey as {0}) when 1 then cast(cast(o_orderdate as date) as {0}) when 2 then concat(cast(cast(o_orderdate as date) as {0}), ' 10:11:12.345') when 3 then {1} when 4 then concat({1}, ' 01:02:03') when 5 then {2} when 6 then {3} else 'unknown' end"
_DATE_SPARK = _DATE.format("string", "date_format(o_orderdate, 'dd/MM/yyyy')", "date_format(o_orderdate, 'dd/MM/yy')", "date_format(o_orderdate, 'yyyy/MM/dd')")
_DATE_DUCK = _DATE.format("varchar", "strftime(o_orderdate, '%d/%m/%Y')", "strftime(o_orderdate, '%d/%m/%y')", "strftime(o_orderdate, '%Y/%m/%d')")
text_query(
    "parse_mixed_date", "orders", "o_orderkey", f"case when year(o_orderdate) < 2000 and o_orderkey % 8 = 5 then 'unknown' else {_DATE_SPARK} end", f"case when year(o_orderdate) < 2000 and o_orderkey % 8 = 5 then 'unknown' else {_DATE_DUCK} end", lambda c: cleaning.parse_mixed_date(c).cast("string"),
    "cast(case when regexp_full_match(x, '\\d{1,6}') then date '1899-12-30' + cast(x as int) when x = 'unknown' then null when contains(x, '-') then cast(x[1:10] as date) when regexp_full_match(x, '\\d{4}/.*') then cast(try_strptime(x, '%Y/%m/%d') as date) when length(x) = 8 then cast(try_strptime(x, '%d/%m/%y') as date) else cast(try_strptime(x[1:10], '%d/%m/%Y') as date) end as varchar)",
)
_CODE = "case when c_custkey % 3 = 0 then concat(' ab', cast(c_nationkey as {0}), '1cd ') when c_custkey % 3 = 1 then concat('m', cast(c_nationkey as {0}), '  2ae') else 'none' end"
text_query("clean_postcode", "customer", "c_custkey", _CODE.format("string"), _CODE.format("varchar"), cleaning.clean_uk_postcode, "case when c_custkey % 3 = 2 then 'NONE' else regexp_replace(upper(trim(x)), '^([A-Z0-9]+?)\\s*([0-9][A-Z]{2})$', '\\1 \\2') end")
_WHO = "case when c_custkey % 3 = 0 then concat('Smith', cast(c_custkey as {0}), ', Jane') when c_custkey % 3 = 1 then concat('Acme - Mr.  John   Doe', cast(c_custkey as {0})) else c_name end"
text_query("clean_contact", "customer", "c_custkey", _WHO.format("string"), _WHO.format("varchar"), cleaning.clean_contact_name, "case when c_custkey % 3 = 0 then 'Jane ' || split_part(x, ',', 1) when c_custkey % 3 = 1 then 'John Doe' || c_custkey else x end")
_FIRM = "case when s_suppkey % 4 = 0 then concat(' big  ', s_name, ' & sons ltd') when s_suppkey % 4 = 1 then concat(s_name, ' Limited') when s_suppkey % 4 = 2 then concat(s_name, ', Inc.') else s_name end"
text_query("clean_company", "supplier", "s_suppkey", _FIRM, _FIRM, cleaning.clean_company_name, "case when s_suppkey % 4 = 0 then 'BIG ' || upper(substr(x, 7, length(x) - 17)) || ' AND SONS' when s_suppkey % 4 = 1 then upper(substr(x, 1, length(x) - 8)) when s_suppkey % 4 = 2 then upper(substr(x, 1, length(x) - 5)) else upper(x) end")
text_query("sanitize_name", "pages", "page_id", "url", "url", cleaning.sanitize_name, "nullif(trim(regexp_replace(lower(trim(x)), '[^a-z0-9]+', '_', 'g'), '_'), '')")
_FILE = "case o_orderkey % 6 when 0 then concat('sales_', {0}, '.csv') when 1 then concat('sales-', {1}, '.csv') when 2 then concat('rep ', {2}) when 3 then concat(lower({3}), '-', {4}, '.csv') when 4 then concat({4}, ' ', substr({3}, 1, 3), '.txt') else 'no digits.csv' end"
text_query(
    "extract_period", "orders", "o_orderkey", _FILE.format(*[f"date_format(o_orderdate, '{p}')" for p in ("yyyyMMdd", "yyMMdd", "yyMM", "MMMM")], "2024"), _FILE.format(*[f"strftime(o_orderdate, '{p}')" for p in ("%Y%m%d", "%y%m%d", "%y%m", "%B")], "2024"),
    cleaning.extract_period, "null",
)
ORACLE["extract_period"] = "select o_orderkey, case o_orderkey % 6 when 0 then strftime(o_orderdate, '%y%m%d') when 1 then strftime(o_orderdate, '%y%m%d') when 2 then strftime(o_orderdate, '%y%m') || '01' when 5 then null else '24' || strftime(o_orderdate, '%m') || '01' end as y from orders"

for _action in ("reject", "warn", "fill"):
    plan_query(
        f"not_null_{_action}",
        one(["orders"], columns=[{"name": "k", "inputs": [{"column": "o_orderkey"}]}, {"name": "s", "inputs": [{"expression": "nullif(o_orderstatus, 'P')"}], "extensions": {"transform": {"name": "not_null", "on_null": _action, "fill_value": "none"}}}]),
        {"reject": "select o_orderkey as k, o_orderstatus as s from orders where o_orderstatus <> 'P'", "warn": "select o_orderkey as k, nullif(o_orderstatus, 'P') as s from orders", "fill": "select o_orderkey as k, coalesce(nullif(o_orderstatus, 'P'), 'none') as s from orders"}[_action],
    )
    plan_query(
        f"in_set_{_action}",
        one(["orders"], columns=[{"name": "k", "inputs": [{"column": "o_orderkey"}]}, {"name": "s", "inputs": [{"expression": "nullif(o_orderstatus, 'P')"}], "extensions": {"transform": {"name": "in_set", "allowed_values": ["F"], "on_violation": _action, "fill_value": "other"}}}]),
        {"reject": "select o_orderkey as k, nullif(o_orderstatus, 'P') as s from orders where o_orderstatus in ('F', 'P')", "warn": "select o_orderkey as k, nullif(o_orderstatus, 'P') as s from orders", "fill": "select o_orderkey as k, case o_orderstatus when 'O' then 'other' when 'P' then null else o_orderstatus end as s from orders"}[_action],
    )

# --- merges -----------------------------------------------------------------------

_T = "(select o_orderkey as k, o_orderstatus as s, o_totalprice as p, o_custkey as c from orders where o_orderkey % 10 < 7)"
_S = "(select o_orderkey as k, case when o_orderkey % 3 = 0 then 'X' else o_orderstatus end as s, case when o_orderkey % 4 = 0 then null else o_totalprice end as p, o_custkey as c from orders where o_orderkey % 10 > 4)"


def _slices(spark, d):
    o = table(spark, d, "orders").dropDuplicates(["o_orderkey"])
    t = o.filter("o_orderkey % 10 < 7").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("p"), F.col("o_custkey").alias("c"))
    s = o.filter("o_orderkey % 10 > 4").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus")).alias("s"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("p"), F.col("o_custkey").alias("c"))
    return t, s


def merge_query(name: str, sql: str, change: Callable | None = None, **spec: object) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        t, s = _slices(spark, d)
        t, s = change(t, s) if change else (t, s)
        return merge.classified(t, s, merge.MergeSpec(("k",), **spec)).withColumnRenamed("_class", "class")  # type: ignore[arg-type]

    QUERIES[name], ORACLE[name] = run, sql


_FULL = f"from {_T} t full join {_S} s on t.k = s.k"
_KIND = "case when t.k is null then 'insert' when s.k is null then 'target_only' else {} end as class"
_OWN = "case when s.k is not null then s.{0} else t.{0} end as {0}"
merge_query("merge_update_all", f"select coalesce(s.k, t.k) as k, {', '.join(_OWN.format(c) for c in 'spc')}, {_KIND.format(chr(39) + 'update' + chr(39))} {_FULL}", strategy="update_all")
merge_query("merge_update_changed", f"select coalesce(s.k, t.k) as k, {', '.join(_OWN.format(c) for c in 'spc')}, {_KIND.format('case when t.s is distinct from s.s or t.p is distinct from s.p or t.c is distinct from s.c then ' + chr(39) + 'update' + chr(39) + ' else ' + chr(39) + 'unchanged' + chr(39) + ' end')} {_FULL}", strategy="update_changed")
merge_query("merge_insert_only", f"select k, s, p, c, 'unchanged' as class from {_T} union all select k, s, p, c, 'insert' from {_S} where k not in (select k from {_T})", strategy="insert_only")
merge_query("merge_accumulating", f"select coalesce(s.k, t.k) as k, {_OWN.format('s')}, coalesce(s.p, t.p) as p, {_OWN.format('c')}, {_KIND.format(chr(39) + 'update' + chr(39))} {_FULL}", strategy="accumulating", milestones=("p",))
merge_query(
    "merge_soft_delete",
    f"select coalesce(s.k, t.k) as k, {', '.join(_OWN.format(c) for c in 'spc')}, case when s.k is not null then s.k % 2 = 0 else true end as is_deleted, case when t.k is null then 'insert' when s.k is null then 'delete' else 'update' end as class {_FULL}",
    lambda t, s: (t.withColumn("is_deleted", F.lit(False)), s.withColumn("is_deleted", F.col("k") % 2 == 0)),
    strategy="soft_delete",
)


def _versions(t, s):
    return t.select("k", "s", "p", F.lit("2000-01-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current")), s.select("k", "s", "p")


@query("merge_scd2", f"""
    with t as (select k, s, p from {_T}), s as (select k, s, p from {_S}), j as (select t.k as tk, s.k as sk, t.s as ts, s.s as ss, t.p as tp, s.p as sp, t.k is not null and s.k is not null and (t.s is distinct from s.s or t.p is distinct from s.p) as changed from t full join s on t.k = s.k)
    select tk as k, ts as s, tp as p, '2000-01-01' as valid_from, case when changed then '2001-02-03' end as valid_to, not changed as is_current from j where tk is not null
    union all select sk, ss, sp, '2001-02-03', null, true from j where sk is not null and (tk is null or changed)""")  # fmt: skip
def _scd2(spark, d):
    t, s = _versions(*_slices(spark, d))
    out = merge.merge(t, s, merge.MergeSpec(("k",), "scd_type2", as_of="2001-02-03"))
    return out.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


@query("replace_partition", "select event_id, event_type from events where not (event_type in ('click', 'view') and day(ts) = 5) union all select -event_id, event_type from events where event_type in ('click', 'view') and day(ts) = 5")
def _replace(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", F.dayofmonth("ts").alias("day"))
    new = e.filter("event_type in ('click', 'view') and day = 5").withColumn("event_id", -F.col("event_id"))
    return merge.replace_partitions(e, new, ["event_type", "day"]).select("event_id", "event_type")


@query("merge_faults", "select l_orderkey, count(*) as n_rows from lineitem group by 1 having count(*) > 1")
def _faults(spark, d):
    return merge.faults(table(spark, d, "lineitem"), ["l_orderkey"])


# --- incremental ------------------------------------------------------------------


@query("watermark_filter", "select o_orderkey from orders where o_orderdate > (select max(o_orderdate) from orders where o_orderkey % 2 = 0 and o_orderdate < timestamp '1999-01-01')")
def _watermark(spark, d):
    o = table(spark, d, "orders")
    mark = incremental.high_mark(o.filter("o_orderkey % 2 = 0 and o_orderdate < timestamp_ntz '1999-01-01'"), "o_orderdate")
    return incremental.later_than(o, "o_orderdate", mark).select("o_orderkey")


@query("period_filter", "select event_id from events where strftime(ts, '%Y-%m-%d') >= (select max(strftime(ts, '%Y-%m-%d')) from events where day(ts) <= 20)")
def _period(spark, d):
    e = _events(spark, d).withColumn("day", F.col("day").cast("string"))
    return incremental.periods_from(e, "day", incremental.high_mark(e.filter(F.dayofmonth("ts") <= 20), "day")).select("event_id")


# --- measures ---------------------------------------------------------------------

AS_OF = "2000-03-31"
_D = "cast(o_orderdate as date)"
_BOUNDS = {
    "today": f"{_D} = date '{AS_OF}'", "yesterday": f"{_D} = date '2000-03-30'", "mtd": f"{_D} between date '2000-03-01' and date '2000-03-31'", "pmtd": f"{_D} between date '2000-02-01' and date '2000-03-02'",
    "last_month": f"{_D} between date '2000-02-01' and date '2000-02-29'", "next_month": f"{_D} between date '2000-04-01' and date '2000-04-30'", "ytd": "true", "ytd_to_date": f"{_D} between date '2000-01-01' and date '2000-03-31'",
    "pytd": "year(o_orderdate) = 1999", "pytd_to_date": f"{_D} between date '1999-01-01' and date '1999-03-31'", "last_12_months": f"{_D} > date '1999-03-31' and {_D} <= date '2000-03-31'",
}
for _name, _bound in _BOUNDS.items():

    def _dated(spark, d, _name=_name):
        out = measures.dated(table(spark, d, "orders"), ["o_orderstatus"], "cast(o_totalprice as decimal(18,2))", "o_orderdate", AS_OF, [_name])
        return out.select("o_orderstatus", F.col(_name).cast("double").alias("total"))

    query(f"m_{_name}", f"select o_orderstatus, cast(sum(cast(o_totalprice as decimal(18,2))) filter ({_bound}) as double) as total from orders group by 1")(_dated)


@query("m_compare", f"with m as (select o_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) filter ({_BOUNDS['ytd_to_date']}) as double) as a, cast(sum(cast(o_totalprice as decimal(18,2))) filter ({_BOUNDS['pytd_to_date']}) as double) as b from orders group by 1) select o_custkey, round(case when b is not null then coalesce((a - b) / nullif(b, 0), 0) end, 6) as change, case when a - b > 0 then '↑' when a - b = 0 then '-' when a - b < 0 then '↓' end as arrow, case when a - b > 0 then 'Positive' when a - b < 0 then 'Negative' when a - b = 0 then 'No Change' end as word from m")
def _compare(spark, d):
    m = measures.dated(table(spark, d, "orders"), ["o_custkey"], "cast(o_totalprice as decimal(18,2))", "o_orderdate", AS_OF, ["ytd_to_date", "pytd_to_date"])
    a, b = F.col("ytd_to_date").cast("double"), F.col("pytd_to_date").cast("double")
    return m.select("o_custkey", F.round(measures.comparator(a, b), 6).alias("change"), measures.arrow(a - b).alias("arrow"), measures.change_word(a - b).alias("word"))


@query("m_12m_avg", f"select o_orderpriority, round(cast(sum(cast(o_totalprice as decimal(18,2))) filter ({_BOUNDS['last_12_months']}) as double) / 12, 4) as average_12_months from orders group by 1")
def _avg12(spark, d):
    m = measures.dated(table(spark, d, "orders"), ["o_orderpriority"], "cast(o_totalprice as decimal(18,2))", "o_orderdate", AS_OF, ["last_12_months"])
    return m.select("o_orderpriority", F.round(F.col("last_12_months").cast("double") / 12, 4).alias("average_12_months"))


@query("m_avgx_date", "select o_orderstatus, round(avg(n), 6) as average_daily from (select o_orderstatus, cast(o_orderdate as date) as d, sum(o_custkey) as n from orders group by 1, 2) group by 1")
def _avgx(spark, d):
    out = measures.average_of_daily_sums(table(spark, d, "orders"), ["o_orderstatus"], "o_custkey", "o_orderdate")
    return out.select("o_orderstatus", F.round("average_daily", 6).alias("average_daily"))


@query("m_allexcept", "select a.o_orderstatus, a.o_orderpriority, b.customers from (select distinct o_orderstatus, o_orderpriority from orders) a join (select o_orderstatus, count(distinct o_custkey) as customers from orders group by 1) b using (o_orderstatus)")
def _allexcept(spark, d):
    return measures.at_coarser_grain(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"], ["o_orderstatus"], F.count_distinct("o_custkey"), "customers").select("o_orderstatus", "o_orderpriority", "customers")


@query("m_currency_switch", "select l_returnflag, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as total from lineitem group by 1")
def _currency(spark, d):
    pick = measures.in_currency({"GBP": "l_extendedprice", "EUR": "l_quantity"}, "GBP", "l_tax")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.sum(pick.cast("decimal(18,2)")).cast("double").alias("total"))


@query("m_ratio", "select l_linestatus, round(coalesce(sum(cast(l_quantity as int)) / nullif(count(*) filter (l_returnflag = 'Z'), 0), -1.0), 6) as r, round(sum(cast(l_quantity as int)) / count(*), 6) as q from lineitem group by 1")
def _ratio(spark, d):
    n = F.sum(F.when(F.col("l_returnflag") == "Z", 1).otherwise(0))
    q = F.sum(F.col("l_quantity").cast("int"))
    return table(spark, d, "lineitem").groupBy("l_linestatus").agg(F.round(measures.ratio(q, n, -1.0), 6).alias("r"), F.round(measures.ratio(q, F.count("*")), 6).alias("q"))


@query("m_dim_filtered", "select l_returnflag, cast(sum(cast(l_quantity as int)) filter (p_size <> 10) as bigint) as volume from lineitem join part on l_partkey = p_partkey group by 1")
def _dim_filtered(spark, d):
    star = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return star.groupBy("l_returnflag").agg(measures.excluding(F.col("l_quantity").cast("int"), F.col("p_size") != 10).alias("volume"))


@query("m_status_filtered", "select o_custkey, count(*) filter (o_orderstatus not in ('F', 'P')) as open_orders from orders group by 1")
def _status(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.when(~F.col("o_orderstatus").isin("F", "P"), 1)).alias("open_orders"))


@query("m_cross_fact", "select nationkey, coalesce(c, 0) - coalesce(s, 0) as surplus from (select c_nationkey as nationkey, count(*) as c from customer group by 1) full join (select s_nationkey as nationkey, count(*) as s from supplier group by 1) using (nationkey)")
def _cross_fact(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("c"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("s"))
    return measures.across_facts([(c, "c"), (s, "s")], ["nationkey"], "coalesce(c, 0) - coalesce(s, 0)", "surplus")


@query("rls_bridge", "select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def _rls(spark, d):
    return measures.visible(table(spark, d, "orders"), table(spark, d, "customer"), "o_custkey", "c_custkey", "c_mktsegment", "BUILDING").select("o_orderkey")


@query("rls_hierarchy", "select c_custkey from customer where c_nationkey < 20 and (c_custkey = 7 or c_nationkey = 7 or c_custkey % 50 = 7)")
def _hierarchy(spark, d):
    p = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("me"), F.col("c_nationkey").cast("string").alias("boss"), (F.col("c_custkey") % 50).cast("string").alias("head"), (F.col("c_nationkey") < 20).alias("manager"))
    return measures.in_hierarchy(p, "7", "me", "boss", "head", "manager").select("c_custkey")


@query("date_dim", """
    select cast(strftime(d, '%Y%m%d') as int) as date_id, cast(d as varchar) as full_date, cast(dayofweek(d) + 1 as int) as day_of_week, strftime(d, '%A') as day_name, cast(day(d) as int) as day_of_month, cast(month(d) as int) as month_number, strftime(d, '%B') as month_name, cast(quarter(d) as int) as quarter, cast(year(d) as int) as year, strftime(d, '%Y-%m') as year_month,
    dayofweek(d) in (0, 6) as is_weekend, cast(year(d) + (month(d) >= 5)::int as int) as financial_year, cast((month(d) + 7) % 12 + 1 as int) as financial_month, cast(((month(d) + 7) % 12) // 3 + 1 as int) as financial_quarter
    from (select cast(unnest(generate_series(date '2020-01-01', date '2021-12-31', interval 1 day)) as date) as d)""")  # fmt: skip
def _date_dim(spark, d):
    days = compiled(spark, {"name": "d", "sources": [{"name": "g", "generated": {"date_start": "2020-01-01", "date_end": "2021-12-31"}}], "stages": [{"name": "a", "columns": cols(date_value="date_value")}]})
    return measures.date_dimension(days).withColumn("full_date", F.col("full_date").cast("string"))


@query("fx_convert", "select o_orderkey, cast(floor(case when o_orderstatus = 'F' then o_totalprice else o_totalprice / (1 + c_nationkey) end * 1000) as bigint) as amount from orders join customer on o_custkey = c_custkey")
def _fx(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.select("o_orderkey", F.floor(measures.in_other_currency(F.col("o_totalprice"), F.col("o_orderstatus"), "F", (1 + F.col("c_nationkey")).cast("double")) * 1000).alias("amount"))


@query("fk_rule", "select o_orderkey, case when o_custkey % 11 = 0 then 0 else coalesce(c_custkey, -1) end as fk, concat_ws('|', cast(o_orderkey as varchar), coalesce(nullif(o_orderstatus, 'P'), '')) as natural_key from orders left join (select * from customer where c_custkey % 5 <> 0) on o_custkey = c_custkey")
def _fk_rule(spark, d):
    o = table(spark, d, "orders").withColumn("key", F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey")))
    c = table(spark, d, "customer").filter("c_custkey % 5 <> 0")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", measures.fk(F.col("key"), F.col("c_custkey")).alias("fk"), measures.natural_key(F.col("o_orderkey"), F.nullif("o_orderstatus", F.lit("P"))).alias("natural_key"))


# --- views over logs --------------------------------------------------------------

_RUNS_SQL = "(select event_id as run_id, event_id % 40 as load_id, case user_id % 4 when 0 then 'silver_t' when 1 then 'gold_t' when 2 then 'bronze_t' else 'x_t' end || user_id % 9 as table_name, case event_type when 'error' then 'failed' when 'signup' then 'skipped' else 'success' end as status, ts as started_at, cast(floor(value) as int) as duration_seconds, event_id % 100 as rows_read, event_id % 7 as rows_rejected from events)"


def _runs(spark, d):
    e = table(spark, d, "events")
    layer = F.when(F.col("user_id") % 4 == 0, "silver_t").when(F.col("user_id") % 4 == 1, "gold_t").when(F.col("user_id") % 4 == 2, "bronze_t").otherwise("x_t")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "skipped").otherwise("success")
    return e.select(F.col("event_id").alias("run_id"), (F.col("event_id") % 40).alias("load_id"), F.concat(layer, (F.col("user_id") % 9).cast("string")).alias("table_name"), status.alias("status"), F.col("ts").alias("started_at"), F.floor("value").cast("int").alias("duration_seconds"), (F.col("event_id") % 100).alias("rows_read"), (F.col("event_id") % 7).alias("rows_rejected"))


_LAYER = "case when table_name like 'bronze%' then 'bronze' when table_name like 'silver%' then 'silver' when table_name like 'gold%' then 'gold' else 'other' end as layer"


@query("v_pipeline_health", f"select table_name, {_LAYER}, run_id, status, rows_read, rows_rejected, case when rows_read > 0 then round(100.0 * rows_rejected / rows_read, 2) else 0.0 end as rejection_rate from {_RUNS_SQL} qualify row_number() over (partition by table_name order by started_at desc, run_id desc) = 1")
def _health(spark, d):
    return views.pipeline_health(_runs(spark, d)).drop("started_at").withColumn("rejection_rate", F.col("rejection_rate").cast("double"))


@query("v_rejection_trend", f"select table_name, cast(cast(started_at as date) as varchar) as run_date, count(*) as runs, count(*) filter (status = 'failed') as failed_runs, count(*) filter (status = 'skipped') as skipped_runs, cast(sum(rows_read) as bigint) as rows_read, cast(sum(rows_rejected) as bigint) as rows_rejected, round(avg(duration_seconds), 6) as avg_duration, max(duration_seconds) as max_duration, case when sum(rows_read) > 0 then round(100.0 * sum(rows_rejected) / sum(rows_read), 2) else 0.0 end as rejection_rate from {_RUNS_SQL} group by 1, 2")
def _trend(spark, d):
    return views.rejection_trend(_runs(spark, d)).withColumns({"rejection_rate": F.col("rejection_rate").cast("double"), "run_date": F.col("run_date").cast("string"), "avg_duration": F.round("avg_duration", 6)})


@query("v_dq_summary", f"select table_name, {_LAYER}, cast(cast(started_at as date) as varchar) as run_date, 'null' as issue_type, case when run_id % 2 = 0 then 'rejected' else 'warned' end as action, 'c' || run_id % 3 as column_name, cast(sum(run_id % 5) as bigint) as affected_rows, count(distinct run_id) as runs from {_RUNS_SQL} group by all")
def _dq(spark, d):
    r = _runs(spark, d)
    q = r.select("run_id", F.lit("null").alias("issue_type"), F.when(F.col("run_id") % 2 == 0, "rejected").otherwise("warned").alias("action"), F.concat(F.lit("c"), (F.col("run_id") % 3).cast("string")).alias("column_name"), (F.col("run_id") % 5).alias("affected_rows"))
    return views.dq_summary(q, r).withColumn("run_date", F.col("run_date").cast("string"))


@query("v_dim_load", f"select load_id, count(distinct run_id) as runs, count(distinct table_name) as tables, cast(min(cast(started_at as date)) as varchar) as load_date from {_RUNS_SQL} group by 1")
def _dim_load(spark, d):
    return views.dim_load(_runs(spark, d)).withColumn("load_date", F.col("load_date").cast("string"))


@query("v_ingestion", "select 'file' as ingestion_type, event_id as run_id, event_type as source, 'SUCCESS' as status, user_id as row_count from events where event_id % 2 = 0 union all select 'list', event_id, event_type, 'FAILED', 0 from events where event_id % 2 = 1")
def _ingestion(spark, d):
    e = table(spark, d, "events")
    f = lambda k, status, n: e.filter(F.col("event_id") % 2 == k).select(F.col("event_id").alias("run_id"), F.col("event_type").alias("source"), F.lit(status).alias("status"), n.alias("row_count"), F.col("ts").alias("at"))
    return views.ingestion({"file": f(0, "SUCCESS", F.col("user_id")), "list": f(1, "FAILED", F.lit(0).cast("long"))}).drop("at")


# --- files ------------------------------------------------------------------------


def _files(spark, d):
    p = table(spark, d, "pages")
    name = F.concat(F.when(F.col("page_id") % 3 == 0, "sales_").otherwise("stock_"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300).cast("int")), "yyyyMMdd"), F.when(F.col("page_id") % 5 == 0, "_draft.csv").otherwise(".csv"))
    return p.select(F.concat(F.lit("Folder "), (F.col("page_id") % 2).cast("string")).alias("folder"), name.alias("file_name"), F.concat(F.lit("/in/"), "page_id").alias("path"), F.lit("csv").alias("extension"), F.lit("2024-01-01").cast("timestamp").alias("modified_on"))


def _rules(spark):
    return spark.createDataFrame([("folder-0", "csv", "sales%", 240101, 240630, "draft", "sales"), ("folder-1", "csv", "%", None, None, None, "all")], "folder_name string, extension string, file_name_wildcard string, time_range_min long, time_range_max long, exclude_file string, target_table string")


_FILES_SQL = "(select 'Folder ' || page_id % 2 as folder, case when page_id % 3 = 0 then 'sales_' else 'stock_' end || strftime(date '2024-01-01' + cast(page_id % 300 as int), '%Y%m%d') || case when page_id % 5 = 0 then '_draft.csv' else '.csv' end as file_name, '/in/' || page_id as path, page_id, cast(strftime(date '2024-01-01' + cast(page_id % 300 as int), '%y%m%d') as int) as period from pages)"
_FITS = "(folder = 'Folder 0' and file_name like 'sales%' and period between 240101 and 240630 and file_name not like '%draft%')"


@query("file_match_rules", f"select path, cast(period as varchar) as period, 'sales' as target_table from {_FILES_SQL} where {_FITS} union all select path, cast(period as varchar), 'all' from {_FILES_SQL} where folder = 'Folder 1'")
def _match(spark, d):
    return ingest.matched_files(_files(spark, d), _rules(spark)).select("path", "period", "target_table")


@query("new_files_anti", f"select path from {_FILES_SQL} where page_id % 4 <> 0")
def _new(spark, d):
    f = _files(spark, d)
    log = f.withColumn("n", F.regexp_extract("path", r"(\d+)", 1).cast("int")).filter("n % 4 in (0, 1)").withColumn("status", F.when(F.col("n") % 4 == 0, "SUCCESS").otherwise("FAILED"))
    # names repeat over folders and dates only where page numbers differ by 600
    return ingest.new_files(f.withColumn("file_name", F.concat("file_name", "path")), log.withColumn("file_name", F.concat("file_name", "path"))).select("path")


@query("reconcile_status", f"select path, case when page_id % 4 = 0 then 'INGESTED' when page_id % 4 = 1 then 'FAILED' when folder = 'Folder 1' or {_FITS} then 'PENDING' else 'UNMATCHED' end as ingestion_status from {_FILES_SQL}")
def _reconcile(spark, d):
    f = _files(spark, d).withColumn("file_name", F.concat("file_name", F.lit("?"), F.regexp_replace("path", "/in/", "")))
    n = F.regexp_extract("path", r"(\d+)", 1).cast("int")
    log = f.withColumn("n", n).filter("n % 4 in (0, 1)").select("folder", "file_name", "modified_on", F.when(F.col("n") % 4 == 0, "SUCCESS").otherwise("FAILED").alias("status"), F.col("modified_on").alias("loaded_on"), F.col("path").alias("run_id"))
    out = ingest.reconciled(f, _rules(spark), log)
    return out.select(F.concat(F.lit("/in/"), F.element_at(F.split("file_name", r"\?"), 2)).alias("path"), "ingestion_status")


@query("ingestion_summary", "select event_type as source, case when user_id % 2 = 0 then 'SUCCESS' else 'FAILED' end as status, count(*) as files, cast(sum(event_id) as bigint) as rows, max(ts) as last_loaded from events group by 1, 2 order by 1, 2")
def _summary(spark, d):
    log = table(spark, d, "events").select(F.col("event_type").alias("source"), F.when(F.col("user_id") % 2 == 0, "SUCCESS").otherwise("FAILED").alias("status"), F.col("event_id").alias("row_count"), F.col("ts").alias("loaded_on"))
    return ingest.summary(log)


@query("latest_failures_topk", "select event_id from events where event_type = 'error' order by ts desc, event_type, event_id limit 10")
def _failures(spark, d):
    log = table(spark, d, "events").select(F.lit("FAILED").alias("status"), F.col("ts").alias("loaded_on"), F.col("event_type").alias("folder"), F.col("event_id").alias("file_name")).filter("folder = 'error'")
    return ingest.latest_failures(log).select(F.col("file_name").alias("event_id"))


# --- writing ----------------------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{shared or tempfile.mkdtemp(prefix='tablewright-')}/query-{uuid.uuid4().hex}"


def _written(spark: SparkSession, parts: list[DataFrame], mode: str, state: dict | None = None, keys: tuple[str, ...] = (), by: tuple[str, ...] = (), **policies: object) -> DataFrame:
    """The table after a plan without columns of its own has written parts one after another, the first by appending."""
    writer = TableWriter(SnapshotStore(spark, _folder(spark)))
    for i, df in enumerate(parts):
        columns = [{"name": c, "natural": c in keys, "inputs": [{"column": c}]} for c in df.columns]
        plan = plan_from({"name": "t", "layer": "gold", "sources": [{"name": "s", "table": "s"}], "columns": columns, "policies": {"load_mode": mode if i else "append", "partition_scheme": list(by)} | policies})
        writer.write(spark, df, plan, registry.Context(state=dict(state or {})))
    return writer.store.read("gold.t")


_PERIOD = "lpad(cast(month(o_orderdate) as varchar), 3, '0')"


def _periods_of_orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.lpad(F.month("o_orderdate").cast("string"), 3, "0").alias("period"))


@query("write_append", f"select o_orderkey, o_totalprice, {_PERIOD} as period from orders union all select -o_orderkey, null, {_PERIOD} from orders where month(o_orderdate) = 7")
def _append(spark, d):
    """Periods are texts like '007', which folders of partitions must not turn into numbers; the second part lacks a column."""
    o = _periods_of_orders(spark, d)
    return _written(spark, [o, o.filter("period = '007'").select((-F.col("o_orderkey")).alias("o_orderkey"), "period")], "append", by=("period",))


@query("write_overwrite", f"select o_orderkey, {_PERIOD} as period from orders where o_orderstatus = 'F'")
def _overwrite(spark, d):
    o = _periods_of_orders(spark, d)
    return _written(spark, [o, table(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", F.lpad(F.month("o_orderdate").cast("string"), 3, "0").alias("period"))], "overwrite", by=("period",))


@query("write_replace_by_partition", f"select o_orderkey, o_totalprice, {_PERIOD} as period from orders where month(o_orderdate) not in (7, 11) union all select -o_orderkey, o_totalprice, {_PERIOD} from orders where month(o_orderdate) in (7, 11)")
def _replaced_periods(spark, d):
    o = _periods_of_orders(spark, d)
    return _written(spark, [o, o.filter("period in ('007', '011')").withColumn("o_orderkey", -F.col("o_orderkey"))], "replace_by_partition", {"replace_by": ["period"]}, by=("period",))


@query("write_merge", f"select o_orderkey, case when o_orderstatus = 'F' then 0.0 else o_totalprice end as o_totalprice, {_PERIOD} as period from orders union all select -o_orderkey, 0.0, {_PERIOD} from orders where o_orderstatus = 'P'")
def _merged_orders(spark, d):
    """Finished orders are updated, reversals inserted. A reversal's negated key may be that of an order (0 always is), so kind is in the merge's key."""
    kind = F.when(F.col("o_orderstatus") == "F", "finished").otherwise("open")
    o = table(spark, d, "orders").select("o_orderkey", kind.alias("kind"), "o_totalprice", F.lpad(F.month("o_orderdate").cast("string"), 3, "0").alias("period"), "o_orderstatus")
    back = o.filter("o_orderstatus = 'P'").withColumns({"o_orderkey": -F.col("o_orderkey"), "kind": F.lit("reversal")})
    new = o.filter("o_orderstatus = 'F'").unionByName(back).withColumn("o_totalprice", F.lit(0.0))
    return _written(spark, [o.drop("o_orderstatus"), new.drop("o_orderstatus")], "merge", keys=("o_orderkey", "kind"), by=("period",), merge_strategy="update_changed").drop("kind")


# --- plans with a layer's defaults --------------------------------------------------

#: Defaults of a layer, in the form that plans of this kind come with: templates as a mapping by name.
LAYER = {
    "metrics": {"schema": "log", "auto_persist": True},
    "dq": {"rejected_table": "log.rejected", "duplicates_table": "log.duplicates", "unresolved_fks_table": "log.unresolved_fks", "unresolved_records_table": "log.unresolved_records"},
    "schemas": ["log", "dimension", "fact"],
    "columns": {"default_string": "Unknown", "default_int": 0, "default_decimal": 0.0, "default_date": "1900-01-01"},
    "common_columns": {"source_modified": {"data_type": "date", "nullable": False, "default": "${defaults.columns.default_date}"}, "source_period": {"data_type": "int", "nullable": False, "default": "${defaults.columns.default_int}"}},
    "optimisation": {"load_mode": "merge", "merge_strategy": "update_changed", "partition_scheme": None},
    "incremental": {"filter_mode": "none", "lookback_days": 0},
}


def _of_layer(spark: SparkSession, plan: dict, sources: dict[str, DataFrame]) -> DataFrame:
    loaded = YamlConfigProvider().load_dict(plan, LAYER)
    assert loaded.policies.load_mode == "merge"
    return PlanBuilder(loaded).build(spark, sources=sources)


@query("dialect_fact", """
    select cast(o_orderkey as varchar) as OrderNaturalID, coalesce(strftime(day, '%Y%m%d'), 'NO_DATE') as FK_DateID, coalesce(cast(c_custkey as varchar), 'NO_CUSTOMER') as FK_CustomerID, cast(cast(o_orderdate as date) as varchar) as DateNaturalID,
    o_shippriority as Quantity, cast(o_totalprice as decimal(18,2)) as TotalAmount, coalesce(case when o_orderstatus = 'F' then cast(o_orderdate as date) end, date '1900-01-01') as source_modified
    from (select *, 1 as o_shippriority from orders) left join (select cast(unnest(generate_series(date '1996-01-01', date '2000-12-31', interval 1 day)) as date) as day) on cast(o_orderdate as date) = day left join (select * from customer where c_mktsegment <> 'BUILDING') on o_custkey = c_custkey""")  # fmt: skip
def _dialect_fact(spark, d):
    """A fact of the layer's form: columns beside stages, lookups with sentinels, templates and macros from the defaults, a check at the end."""
    plan = {
        "name": "f_orders", "layer": "gold", "target_schema": "fact", "natural_key": ["OrderNaturalID"],
        "policies": {"orchestration": {"active": True, "batch": 2, "order": 10}, "creation": {"notebook_name": "template"}, "optimisation": {"load_mode": "merge"}},
        "sources": [{"name": "src", "table": "silver.orders"}, {"name": "d_date", "table": "dimension.d_date", "broadcast": True}, {"name": "d_customer", "table": "dimension.d_customer", "broadcast": True}],
        "incremental": {"filter_mode": "watermark", "watermark_column": "DateNaturalID", "source_watermark_column": "o_orderdate"},
        "columns": [
            {"name": "OrderNaturalID", "data_type": "string", "nullable": False, "inputs": [{"source": "src", "column": "o_orderkey"}]},
            {"name": "FK_DateID", "data_type": "string", "nullable": False, "default": "NO_DATE", "inputs": [{"expression": "COALESCE(d_date.DateID, 'NO_DATE')"}]},
            {"name": "FK_CustomerID", "data_type": "string", "nullable": False, "default": "NO_CUSTOMER", "inputs": [{"expression": "COALESCE(d_customer.CustomerID, 'NO_CUSTOMER')"}]},
            {"name": "DateNaturalID", "data_type": "string", "nullable": False, "inputs": [{"source": "src", "column": "order_day"}]},
            {"name": "Quantity", "data_type": "int", "default": "${defaults.columns.default_int}", "inputs": [{"expression": "1"}]},
            {"name": "TotalAmount", "data_type": "decimal(18,2)", "nullable": False, "default": 0.0, "inputs": [{"source": "src", "column": "o_totalprice"}]},
            {"name": "source_modified", "inputs": [{"expression": "CASE WHEN src.o_orderstatus = 'F' THEN src.order_day END"}]},
        ],
        "stages": [
            {"name": "join_dimensions", "type": "transformation", "joins": [
                {"source": "d_date", "type": "left", "conditions": [{"left": "DateNaturalID", "right": "DateKey"}]},
                {"source": "d_customer", "type": "left", "conditions": [{"left_source": "src", "left_column": "o_custkey", "right": "CustomerNaturalID"}]},
            ]},
            {"name": "check_unresolved_fks", "extensions": {"stage_plugin": "check_unresolved_fks", "summary_table": "${defaults.dq.unresolved_fks_table}", "records_table": "${defaults.dq.unresolved_records_table}", "checks": [{"column": "FK_DateID", "sentinel": "NO_DATE"}, {"column": "FK_CustomerID", "sentinel": "NO_CUSTOMER"}]}},
        ],
    }
    days = readers.generated(spark, {"date_start": "1996-01-01", "date_end": "2000-12-31"}).select(F.date_format("date_value", "yyyyMMdd").alias("DateID"), F.col("date_value").cast("string").alias("DateKey"))
    customers = table(spark, d, "customer").filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").cast("string").alias("CustomerID"), F.col("c_custkey").alias("CustomerNaturalID"))
    orders = table(spark, d, "orders").withColumn("order_day", F.col("o_orderdate").cast("date"))
    return _of_layer(spark, plan, {"src": orders, "d_date": days, "d_customer": customers})


@query("dialect_date", """
    select md5(cast(day as varchar)) as DateID, cast(day as varchar) as DateNaturalID, day as FullDate, strftime(day, '%B') as MonthName, cast(year(day) as int) as Year, dayofweek(day) in (0, 6) as IsWeekend, date '2024-01-01' as source_modified, 0 as source_period
    from (select cast(unnest(generate_series(date '2020-01-01', date '2030-01-01', interval 1 day)) as date) as day)
    union all select 'NO_DATE', '1900-01-01', date '1900-01-01', '!! Unknown', 1900, null, null, null""")  # fmt: skip
def _dialect_date(spark, d):
    """A generated dimension with a sentinel row; its period column comes whole from the layer's template."""
    shown = {"DateID": ("string", "md5(CAST(date_value AS STRING))"), "DateNaturalID": ("string", "CAST(date_value AS STRING)"), "FullDate": ("date", "date_value"), "MonthName": ("string", "date_format(date_value, 'MMMM')"), "Year": ("int", "year(date_value)"), "IsWeekend": ("boolean", "dayofweek(date_value) IN (1, 7)")}
    plan = {
        "name": "d_date", "layer": "gold", "target_schema": "dimension", "natural_key": ["DateNaturalID"], "policies": {"orchestration": {"active": True, "batch": 0}, "optimisation": {"load_mode": "merge", "merge_strategy": "insert_only"}},
        "sources": [{"name": "generated", "generated": {"kind": "dates"}}],
        "columns": [{"name": n, "data_type": t, "nullable": False, "inputs": [{"expression": e}]} for n, (t, e) in shown.items()] + [{"name": "source_modified", "inputs": [{"expression": "DATE'2024-01-01'"}]}, {"name": "source_period"}],
        "stages": [{"name": "add_sentinels", "extensions": {"stage_plugin": "ensure_sentinels", "records": [{"DateID": "NO_DATE", "DateNaturalID": "1900-01-01", "FullDate": "1900-01-01", "MonthName": "!! Unknown", "Year": 1900}]}}],
    }
    return _of_layer(spark, plan, {"generated": readers.generated(spark, {"kind": "dates"})})


@query("dialect_customer", "select cast(c_custkey as varchar) as customer_id, coalesce(nullif(c_mktsegment, 'BUILDING'), 'Unknown') as segment, cast(c_nationkey as varchar) as country, c_acctbal > 0 as is_active, date '1900-01-01' as source_modified from customer")
def _dialect_customer(spark, d):
    plan = {
        "name": "customer", "layer": "silver", "target_schema": "silver", "natural_key": ["customer_id"], "policies": {"optimisation": {"merge_strategy": "update_changed", "hash_columns": ["segment", "country"]}}, "sources": [{"name": "src", "table": "bronze.raw_customers"}],
        "columns": [
            {"name": "customer_id", "data_type": "string", "nullable": False, "inputs": [{"source": "src", "column": "c_custkey"}]},
            {"name": "segment", "data_type": "string", "default": "${defaults.columns.default_string}", "inputs": [{"expression": "nullif(src.c_mktsegment, 'BUILDING')"}]},
            {"name": "country", "data_type": "string", "inputs": [{"source": "src", "column": "c_nationkey"}]},
            {"name": "is_active", "data_type": "boolean", "default": True, "inputs": [{"expression": "CASE WHEN src.c_acctbal > 0 THEN true ELSE false END"}]},
            {"name": "source_modified", "inputs": [{"expression": "CAST(NULL AS DATE)"}]},
        ],
    }
    return _of_layer(spark, plan, {"src": table(spark, d, "customer")})


@query("fact_three_stages", """
    with a as (select l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey as line_key, l_partkey, o_custkey, l_quantity, l_extendedprice, l_discount, o_orderstatus from lineitem join orders on l_orderkey = o_orderkey),
    b as (select a.*, coalesce(c_custkey, -1) as fk_customer, coalesce(p_partkey, -1) as fk_part, p_size, p_retailprice, c_nationkey from a left join (select * from customer where c_mktsegment <> 'BUILDING') on o_custkey = c_custkey left join (select * from part where p_size > 5) on l_partkey = p_partkey)
    select line_key, fk_customer, fk_part, round(case when n_name = 'FRANCE' then l_extendedprice else l_extendedprice / nullif(1 + n_nationkey, 0) end, 6) as amount_in_currency, l_quantity * p_size as volume, round(l_extendedprice - coalesce(p_retailprice * l_quantity, 0) - coalesce(l_discount, 0), 6) as margin
    from b left join nation on c_nationkey = n_nationkey where upper(o_orderstatus) = 'F'""")  # fmt: skip
def _three_stages(spark, d):
    """Natural keys, then lookups with defaults, then other currencies, volume and margin; only invoiced rows stay."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    own = lines.select(measures.natural_key(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")).alias("line_key"), "l_partkey", "o_custkey", "l_quantity", "l_extendedprice", "l_discount", "o_orderstatus")
    customers, parts = table(spark, d, "customer").filter("c_mktsegment <> 'BUILDING'"), table(spark, d, "part").filter("p_size > 5")
    found = own.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    found = found.withColumns({"fk_customer": measures.fk(F.col("o_custkey"), F.col("c_custkey")), "fk_part": measures.fk(F.col("l_partkey"), F.col("p_partkey"))})
    rated = found.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").filter(F.upper("o_orderstatus") == "F")
    amount, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return rated.select(
        "line_key", "fk_customer", "fk_part", F.round(measures.in_other_currency(amount, F.col("n_name"), "FRANCE", (1 + F.col("n_nationkey")).cast("double")), 6).alias("amount_in_currency"),
        measures.volume(quantity, F.col("p_size")).alias("volume"), F.round(measures.margin(amount, F.col("p_retailprice"), quantity, F.col("l_discount")), 6).alias("margin"),
    )


@query("dim_attribute_chain", "select s_suppkey, s_name like '%1%' as has_one, region from supplier left join (select n_nationkey, r_name as region from nation join region on n_regionkey = r_regionkey where r_name in ('ASIA', 'EUROPE')) on s_nationkey = n_nationkey")
def _attribute(spark, d):
    named = table(spark, d, "region").filter(F.col("r_name").isin("ASIA", "EUROPE"))
    chain = [(table(spark, d, "nation"), "s_nationkey", "n_nationkey"), (named, "n_regionkey", "r_regionkey")]
    out = measures.with_attribute(table(spark, d, "supplier"), "s_nationkey", chain, "r_name", "region")
    return out.select("s_suppkey", F.col("s_name").like("%1%").alias("has_one"), "region")


@query("bridge_users", "select distinct cast(user_id as varchar) || '|' || event_type as natural_key, coalesce(c_custkey, -1) as fk_user, coalesce(n_nationkey, -1) as fk_entity, event_type = 'error' as is_delete from events left join customer on user_id = c_custkey left join (select * from nation where n_regionkey <> 1) on c_nationkey = n_nationkey")
def _bridge(spark, d):
    pairs = table(spark, d, "events").select("user_id", "event_type").distinct()
    both = pairs.join(table(spark, d, "customer"), F.col("user_id") == F.col("c_custkey"), "left").join(table(spark, d, "nation").filter("n_regionkey <> 1"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return both.select(measures.natural_key(F.col("user_id"), F.col("event_type")).alias("natural_key"), F.coalesce("c_custkey", F.lit(-1)).alias("fk_user"), F.coalesce("n_nationkey", F.lit(-1)).alias("fk_entity"), (F.col("event_type") == "error").alias("is_delete"))


@query("m_field_parameter", "select o_orderstatus, field, field_order, value from (select o_orderstatus, cast(count(*) as double) as n, cast(max(o_custkey) as double) as m from orders group by 1) cross join (values ('Orders', 0), ('Last customer', 1)) as v(field, field_order) cross join lateral (select case field_order when 0 then n else m end as value)")
def _field_parameter(spark, d):
    sums = table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("o_custkey").alias("m"))
    return measures.by_field(sums, ["o_orderstatus"], [("Orders", "n"), ("Last customer", "m")])


@query("m_selected_value", "select o_custkey, case when min(o_orderstatus) = max(o_orderstatus) then min(o_orderstatus) else 'several' end as status, '£' || format('{:,}', cast(max(o_custkey) as bigint)) as shown from orders group by 1")
def _selected(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(measures.selected(F.col("o_orderstatus"), "several").alias("status"), measures.shown(F.max("o_custkey"), "£").alias("shown"))


@query("v_dq_layers", "select 'rejected' as kind, layer, cast(o_orderkey as varchar) as id from (select 'silver' as layer, * from orders where o_orderstatus = 'P' union all select 'gold', * from orders where o_orderstatus = 'F') union all select 'duplicates', 'silver', l_orderkey || ',' || l_linenumber from (select * from lineitem qualify count(*) over (partition by l_orderkey, l_linenumber) > 1)")
def _dq_layers(spark, d):
    of = lambda status: stages.rejected_records(table(spark, d, "orders").filter(F.col("o_orderstatus") == status), ["o_orderkey"], "r", "o_orderstatus", "in_set", "orders")
    bad = views.rejected({"silver": of("P"), "gold": of("F")}).select(F.lit("rejected").alias("kind"), "layer", F.get_json_object("natural_id", "$.o_orderkey").alias("id"))
    # natural_keys names the columns; the rows' own keys stand in the records
    again = views.of_layers({"silver": stages.duplicate_records(table(spark, d, "lineitem"), _LINE, "lineitem")}, views.DUPLICATES | {"_dq_natural_id": "natural_id"})
    id_ = F.concat_ws(",", F.get_json_object("natural_id", "$.l_orderkey"), F.get_json_object("natural_id", "$.l_linenumber"))
    return bad.unionByName(again.select(F.lit("duplicates").alias("kind"), "layer", id_.alias("id")))


@query("v_unresolved", f"select 'gold' as layer, 'fk_customer' as fk_column, count(*) filter (fk_customer = -1) as unresolved_count from {_FACT} union all select 'silver', 'fk_status', count(*) filter (fk_status = 'NO_STATUS') from {_FACT}")
def _unresolved_views(spark, d):
    f = _fact(spark, d)
    return views.unresolved({"gold": stages.unresolved_fks(f, _CHECKS[:1]), "silver": stages.unresolved_fks(f, _CHECKS[1:])}).select("layer", "fk_column", "unresolved_count")


@query("v_dim_run", f"select run_id, load_id, table_name, {_LAYER}, status, started_at, duration_seconds from {_RUNS_SQL}")
def _dim_run(spark, d):
    return views.dim_run(_runs(spark, d))


def _logged(name: str, action: str, condition: str, sql: str, **options: object) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        context = registry.Context(keys=["k"], table="t", run_id="r1")
        plan = plan_from(one([{"name": "orders", "path": f"{d}/orders.parquet"}], columns=[{"name": "k", "inputs": [{"column": "o_orderkey"}]}, {"name": "s", "inputs": [{"expression": "nullif(o_orderstatus, 'P')"}], "extensions": {"transform": {"name": name, "log_table": "log", "sample_limit": 1_000_000_000, condition: action} | options}}]) | {"name": name})
        kept = PlanBuilder(plan).build(spark, context)
        logged = context.rows["log"][0]
        return kept.select(F.lit("kept").alias("part"), F.col("k").cast("string").alias("k")).unionByName(logged.select(F.lit("logged").alias("part"), F.regexp_extract(F.to_json(F.struct(*logged.columns)), r"k[^0-9]*([0-9]+)", 1).alias("k")))

    QUERIES[name], ORACLE[name] = run, sql


_logged("log_nulls_to_table", "reject", "on_null", "select 'kept' as part, cast(o_orderkey as varchar) as k from orders where o_orderstatus <> 'P' union all select 'logged', cast(o_orderkey as varchar) from orders where o_orderstatus = 'P'")
_logged("log_invalid_to_table", "warn", "on_violation", "select 'kept' as part, cast(o_orderkey as varchar) as k from orders union all select 'logged', cast(o_orderkey as varchar) from orders where o_orderstatus = 'O'", allowed_values=["F"])


@query("watermark_overrides", "select o_orderkey from orders where o_orderdate > timestamp '1997-06-30'")
def _overrides(spark, d):
    """A date given by hand beats the table's, which counts only where it is earlier than the high-water mark."""
    o = table(spark, d, "orders")
    mark = incremental.high_mark(o, "o_orderdate")
    mark = incremental.chosen_mark(mark, "not a date", None)
    assert mark == incremental.high_mark(o, "o_orderdate")
    return incremental.later_than(o, "o_orderdate", incremental.chosen_mark(mark, "1997-06-30", None)).select("o_orderkey")


# --- text files -----------------------------------------------------------------------


def _csv_file(spark: SparkSession, d: str, below: int) -> str:
    """The nations as a CSV file with title lines, a header and quoted cells; names and headers as systems give them out."""
    folder = _folder(spark)
    rows = table(spark, d, "nation").select(F.lit(1).alias("o"), F.col("n_nationkey").alias("k"), F.concat(F.col("n_nationkey"), F.lit(',"'), F.col("n_name"), F.lit(', the ""great"""'), F.lit(","), F.col("n_regionkey")).alias("value"))
    head = spark.createDataFrame([(0, i, f"Title {i}") for i in range(below)] + [(0, below, "Nation ID,Nation Name,Region,,Region")], "o int, k int, value string")
    head.unionByName(rows).orderBy("o", "k").coalesce(1).sortWithinPartitions("o", "k").select("value").write.text(folder)
    return folder


@query("csv_header_marker", "select cast(n_nationkey as varchar) as nation_id, n_name || ', the \"great\"' as nation_name, cast(n_regionkey as varchar) as region, null as c3, null as region_1 from nation")
def _csv_marker(spark, d):
    df = readers.read_csv_file(spark, _csv_file(spark, d, 3), header_marker="nation id")
    return df.toDF(*ingest.sanitized(df.columns)).withColumnsRenamed({"_c3": "c3", "col_3": "c3"})


@query("csv_header_line", "select cast(n_nationkey as varchar) as id, cast(n_regionkey as varchar) as area, 'r1' as _run_id, 'nations.csv' as _source_file from nation")
def _csv_line(spark, d):
    """A header by line number, columns by rules of prefixes, all as text with the run's marks."""
    df = readers.read_file(spark, {"path": _csv_file(spark, d, 2), "extension": "csv", "header_start": 3})
    df = ingest.normalized(df.toDF(*ingest.sanitized(df.columns)), "nation_id:id,region:area").select("id", "area")
    out = ingest.stamped(df, "r1", {"source": "s", "file_name": "nations.csv", "folder": "f"}, None)
    return out.select("id", "area", "_run_id", "_source_file")


@query("csv_profile", "select 'csv' as extension, 4 as header_start, 'Nation ID|Nation Name|Region|col_3|Region' as columns, (select count(*) from nation) + 4 as row_count from region where r_regionkey = 0")
def _csv_profile(spark, d):
    """Blank title lines aren't taken for a header, nor are lines of fewer cells than half."""
    folder = _folder(spark)
    rows = table(spark, d, "nation").select(F.lit(1).alias("o"), F.concat_ws(",", "n_nationkey", "n_name", "n_regionkey").alias("value"))
    spark.createDataFrame([(0, " "), (0, ""), (0, ",,,"), (0, "Nation ID,Nation Name,Region,,Region")], "o int, value string").unionByName(rows).coalesce(1).select("value").write.text(folder)
    path = spark.read.text(folder).select("_metadata.file_path").first()[0]
    files = spark.createDataFrame([("f", "nations 2401.csv", path, "csv", None)], "folder string, file_name string, path string, extension string, modified_on timestamp")
    return profiling.profiled(spark, files).select("extension", F.col("header_start").cast("int").alias("header_start"), F.concat_ws("|", "column_names").alias("columns"), "row_count")
