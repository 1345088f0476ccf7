"""Registered queries against their SQL on tables that hold what the given ones do not."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from oracle import TABLES, compare, connect

SF = "/root/testdata/sf0.001"


def equals_sql(spark, folder, name, table, select):
    """Compare on the smallest data with one table replaced."""
    for t in TABLES:
        if t != table:
            os.symlink(f"{SF}/{t}.parquet", f"{folder}/{t}.parquet")
    duckdb.sql(f"copy ({select}) to '{folder}/{table}.parquet' (format parquet)")
    same, n, expected, diff = compare(
        spark, connect(folder), contract.queries()[name], contract.oracle_sql()[name], str(folder)
    )
    assert same and n, f"{n} rows, expected {expected}: {diff}"


def test_positions_rise_in_files_of_all_lengths(spark, tmp_path):
    """A user's last two events stand on both sides of the thousandth."""
    events = f"""
      select event_id, ts, user_id,
             case when event_id % 2 = 0 then 'signup' else 'error' end event_type, "value", props
      from (select * replace (event_id // 2 as user_id, event_id + 999 as event_id) from '{SF}/events.parquet')"""
    equals_sql(spark, tmp_path, "apply_changes_rollover", "events", events)


@pytest.mark.parametrize("value", ["-0.0", "0.0", "-0.001", "-1.5"])
def test_literals_of_zero(spark, tmp_path, value):
    customers = f"""select * replace (cast('{value}' as double) as c_acctbal) from '{SF}/customer.parquet' limit 20"""
    equals_sql(spark, tmp_path, "literal_values", "customer", customers)
