"""Registered queries against their SQL at the smallest scale, streams included."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
CHOSEN = ["ods_json_gate", "dwd_cdc_validity", "dwd_trade_order_detail", "dwd_display_log",
          "dwd_log_split_counts", "fact_settled", "fact_changelog", "fact_dirty_union",
          "dws_sku_window", "dws_traffic_window", "ads_trade_sku_order_topn_today",
          "dash_summary", "dim_snapshot", "stream_log_split", "stream_traffic_window",
          "stream_sku_window", "stream_fact", "stream_dim_snapshot", "sku_fact_dirty",
          "page_view_dirty", "e2e_fact_settled", "e2e_sku_topn", "e2e_dirty"]


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for table in check.TABLES:
        made.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return made


def test_every_query_has_its_sql():
    own = {n for n in entry.queries() if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own == {n for n in entry.oracle_sql() if not re.match(r"op\d+_", n)}


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, con, name):
    verdict, _ = check.compare(spark, con, SF, name, entry.queries()[name],
                               entry.oracle_sql()[name])
    assert verdict == "ok"


def test_entry(spark):
    assert entry.entry(spark).count() == 10
