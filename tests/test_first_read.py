"""The as-of query as the first thing that a session does: its table's columns have the lowest numbers of expressions."""

import subprocess
import sys
from pathlib import Path

import pytest

from tidemark.operators import ordered

PLAIN = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__
rows = __spark_entry__.queries()["asof_last_purchase"](spark, sys.argv[1])
print("ROWS", rows.count(), rows.where("last_value is not null").count())
"""


def test_asof_query_first_in_a_session(small):
    import duckdb

    from __spark_entry__ import oracle_sql

    done = subprocess.run([sys.executable, "-c", PLAIN, small], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW events AS SELECT * FROM '{small}/events.parquet'")
        wanted = c.execute(f"SELECT COUNT(*), COUNT(last_value) FROM ({oracle_sql()['asof_last_purchase']})").fetchone()
    assert f"ROWS {wanted[0]} {wanted[1]}" in done.stdout


@pytest.mark.parametrize("n", [2, 7, 40])
def test_ranges_ascend_with_odd_values(spark, n):
    values = [None, float("-inf"), float("inf"), float("nan"), *[float(v % 13) for v in range(300)]]
    rows = ordered.in_ranges(spark.createDataFrame([(v,) for v in values], "v double"), "v", n).orderBy("v").collect()
    found = [r._range for r in rows]
    assert found == sorted(found) and found[0] == 0  # nulls first, NaN last
    of = {}
    for r in rows:
        assert of.setdefault(str(r.v), r._range) == r._range
    assert len(set(found)) >= min(n, 7)
