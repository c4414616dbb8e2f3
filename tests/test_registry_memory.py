"""The rule for a registry's memory over all orders, against DuckDB, and its plan."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.operators import monitor
from tidemark.sources import canon


@pytest.mark.parametrize("per_mode", [False, True])
def test_memory_over_all_orders(spark, per_mode):
    d = "/root/testdata/sf0.01"
    champion = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority"))
    rows = canon.table(spark, d, "orders").select(F.col("o_orderkey").alias("seq"), champion.alias("champion"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("mode"))
    made = monitor.memory_rule(rows, per_mode)
    want = duckdb.sql(
        f"""SELECT o_orderkey, last_value(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END IGNORE NULLS) OVER ({"PARTITION BY nullif(o_orderstatus, 'P')" if per_mode else ""} ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        FROM '{d}/orders.parquet'"""
    ).fetchall()
    assert made.columns == ["seq", "champion", "mode", "previous"]
    assert sorted((r.seq, r.previous) for r in made.collect()) == sorted(want) and len(want) == 15_000
    assert monitor.memory_rule(rows.limit(0), per_mode).count() == 0


def test_no_window_holds_all_rows(spark, capsys):
    rows = spark.range(1000).select(F.col("id").alias("seq"), F.lit("a").alias("champion"), F.lit("m").alias("mode"))
    monitor.memory_rule(rows, False).explain()
    plan = capsys.readouterr().out
    assert all("_range" in line for line in plan.splitlines() if "Window [" in line) and "Window [" in plan
