"""Queries against their oracles on tables full of NULLs, odd names and hot keys."""

import duckdb
import pytest

import __spark_entry__ as e
from starmill.plans import orders
from tests.compare import compare, oracle_connection

HARD = {
    "orders": """
        select o_orderkey,
          case when o_orderkey % 97 = 0 then null when o_orderkey % 3 = 0 then 7
               else o_custkey end as o_custkey,
          case when o_orderkey % 89 <> 0 then o_orderstatus end as o_orderstatus,
          case when o_orderkey % 83 <> 0 then o_totalprice end as o_totalprice,
          case when o_orderkey % 79 <> 0 then o_orderdate end as o_orderdate,
          case when o_orderkey % 73 = 0 then null when o_orderkey % 71 = 0 then '9-0'
               else o_orderpriority end as o_orderpriority
        from '{folder}/orders.parquet'""",
    "customer": """
        select c_custkey,
          case when c_custkey % 31 = 0 then null when c_custkey % 37 = 0 then '   '
               when c_custkey % 41 = 0 then ' Café ÄÖ ' || c_custkey
               when c_custkey % 43 = 0 then 'Dup' else c_name end as c_name,
          case when c_custkey % 29 = 0 then null when c_custkey % 23 = 0 then ' building '
               when c_custkey % 19 = 0 then 'nan' else c_mktsegment end as c_mktsegment
        from '{folder}/customer.parquet'""",
    "lineitem": """
        select case when l_partkey % 3 = 0 then 5 else l_orderkey end as l_orderkey,
          case when l_partkey % 5 = 0 then null when l_partkey % 3 = 1 then 1
               else l_partkey end as l_partkey, l_linenumber
        from '{folder}/lineitem.parquet'""",
    "part": """
        select p_partkey,
          case when p_partkey % 17 = 0 then null when p_partkey % 13 = 0 then 'a;b'
               when p_partkey % 11 = 0 then '  ' when p_partkey % 7 = 0 then 'Economy'
               when p_partkey % 19 = 0 then '1-Jan-20' when p_partkey % 23 = 0 then 'nan'
               else p_type end as p_type
        from '{folder}/part.parquet'""",
}
NAMES = [
    "a1_landing", "j01_domain_category", "j04_domain_app", "j05_insert_if_absent", "j13_snapshot",
    "j14_genre", "j15_bridge", "j17_enriched_snapshot", "j18_baseline_scorecard",
    "j24_raw_rows_not_loaded", "j32_clean_snapshot", "j34_audit_log", "j41_j44_dim_app_type",
    "j45_dim_date", "j46_fact", "j47_dw_bridge", "j52_genre_membership",
    "j53_genre_weighted_kpis", "j57_cleaning_checks", "j59_warehouse_checks", "j60_weight_checks",
    "j62_stage_one_checks", "j64_by_category", "j67_over_time", "k2_foreign_keys",
]


@pytest.fixture(scope="module")
def hard(folder, tmp_path_factory):
    target = tmp_path_factory.mktemp("hard")
    con = duckdb.connect()
    for name, sql in HARD.items():
        query = sql.format(folder=folder)
        con.execute(f"copy ({query}) to '{target}/{name}.parquet' (format parquet)")
    return str(target)


@pytest.fixture(scope="module")
def con(hard):
    return oracle_connection(hard)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, hard, con, name):
    assert compare(e.queries()[name](spark, hard), con, e.oracle_sql()[name]) == ""


def test_changed_tables_give_new_layers(spark, hard):
    before = orders.layers(spark, hard)
    assert orders.layers(spark, hard) is before
    duckdb.connect().execute(
        f"copy (select * from '{hard}/orders.parquet' limit 100) to '{hard}/new.parquet'"
    )
    changed = duckdb.connect()
    changed.execute(f"create table o as select * from '{hard}/new.parquet'")
    changed.execute(f"copy o to '{hard}/orders.parquet' (format parquet)")
    after = orders.layers(spark, hard)
    assert after is not before and after["raw"].count() < 100
