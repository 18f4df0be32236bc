"""The workload and its SQL on tables that hold what the given ones do not: nulls, negative amounts, missing years."""

import duckdb
import pytest

from oracle_check import compare
from runlens.plans import ORACLES, QUERIES, runner

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

ALTERED = {
    "lineitem": """SELECT * REPLACE (
        CASE WHEN l_orderkey % 11 = 0 OR (l_orderkey + l_linenumber) % 7 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
        CASE WHEN (l_partkey + l_linenumber) % 5 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS l_extendedprice)
      FROM {} WHERE NOT (year(l_shipdate) IN (1998, 2000) AND l_partkey % 2 = 0)""",
    "part": "SELECT * REPLACE (CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_type END AS p_type) FROM {}",
}


@pytest.fixture(scope="module")
def altered(tmp_path_factory):
    folder, con = tmp_path_factory.mktemp("altered"), duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        rows = ALTERED.get(name, "SELECT * FROM {}").format(f"'{SF}/{name}.parquet'")
        con.execute(f"COPY ({rows}) TO '{folder}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("w")])
def test_workload_on_altered_tables(spark, altered, name):
    folder, con = altered
    assert compare(spark, con, name, runner(name), ORACLES[name], folder) == []
