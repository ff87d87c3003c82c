"""One order holds a third of all lines and one customer a third of all orders."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from oracle import difference


@pytest.fixture(scope="module")
def skewed(sf_dir, tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    changes = {
        "lineitem": "replace (case when rowid % 3 = 0 then 5 else l_orderkey end as l_orderkey, "
        "case when rowid % 3 = 0 then 1 else l_linenumber end as l_linenumber)",
        "orders": "replace (case when rowid % 3 = 0 then 7 else o_custkey end as o_custkey)",
    }
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create table {name} as select * from read_parquet('{path}')")
        con.execute(f"copy (select * {changes.get(name, '')} from {name}) to '{out}/{name}.parquet' (format parquet)")
    return str(out)


@pytest.mark.parametrize("name", ["describe", "row_key", "rows_by_id_list", "fold_transform", "assemble_features"])
def test_query_on_skewed_tables(spark, skewed, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert difference(entry.queries()[name](spark, skewed), entry.oracle_sql()[name], skewed) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
