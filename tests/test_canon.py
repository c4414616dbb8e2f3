"""The canonical facts: what is moved, odd keys, and the join for more suppliers than are broadcast, against the oracles' SQL."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest

from tidemark.plans.sql import CAPACITY, DEMAND, PICKUP, with_
from tidemark.sources import canon

DAY = datetime(2000, 1, 1)
SHAPES = {
    "region": ("r_regionkey int, r_name string", [(0, "EAST"), (1, "WEST"), (2, "EAST"), (3, "UNUSED")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(k, f"n{k}", (0, 1, 2, 9, None)[k % 5]) for k in range(10)]),
    "supplier": ("s_suppkey bigint, s_nationkey int", [(k, None if k == 50 else k % 11) for k in range(60)]),
    "orders": ("o_orderkey bigint, o_orderdate timestamp", [(k, None if k == 7 else DAY + timedelta(days=k % 40)) for k in range(200)]),
    "lineitem": ("l_orderkey bigint, l_suppkey bigint, l_quantity double, l_shipdate timestamp", [(None if k == 3 else k % 210, None if k == 4 else k % 64, float(k % 50), DAY + timedelta(days=(k % 40) + k % 23 - 5, hours=k % 24)) for k in range(4000)]),
}


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("odd")
    for name, (schema, rows) in SHAPES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return str(at)


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_facts_of_odd_keys(spark, odd, most, monkeypatch):
    import duckdb

    monkeypatch.setattr(canon, "BROADCAST_SUPPLIERS", most)
    monkeypatch.setattr(canon, "_FEW", {})
    with duckdb.connect() as c:
        for name in SHAPES:
            c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(odd)}/{name}.parquet/*.parquet'")
        for made, ctes in (("demand", [DEMAND]), ("pickup", [DEMAND, PICKUP]), ("capacity", [DEMAND, CAPACITY])):
            found = getattr(canon, made)(spark, odd)
            wanted = c.execute(with_(*ctes) + f"SELECT {', '.join(found.columns)} FROM {made}").fetchall()
            assert sorted(map(tuple, found.collect())) == sorted(wanted) and len(wanted) > 20


def test_no_line_is_moved_to_its_supplier(spark, small, capsys):
    for made in (canon.demand, canon.pickup):
        made(spark, small).explain()
        plan = [x for x in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in x]
        assert plan and not any("suppkey" in x for x in plan)  # before: sums by supplier and days, as many as lines, moved twice


def test_queries_of_the_facts_read_the_lines_once(spark, small, capsys):
    import __spark_entry__

    from tidemark.plans import forecasts

    def reads(df):
        df.explain()
        return capsys.readouterr().out.count("l_shipdate")

    assert reads(forecasts.MADE["capacity"](spark, small)) == 0  # from the demand that is kept
    for name in ("curve_predict", "pickup_curves", "booked_by_band", "accuracy_table", "metrics_without_cold_start"):
        assert reads(__spark_entry__.queries()[name](spark, small)) == 0, name
