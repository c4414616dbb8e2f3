"""Shards against DuckDB's statement of the same sums, also for hot texts and odd rows."""

import duckdb
import pytest

from tidemark.llm import sharding, statements


@pytest.mark.parametrize("kind", ["given", "hot", "odd", "empty"])
def test_shards_agree_with_sql(spark, small, kind):
    schema = "doc_id long, text string, key string, salt int, size string, shard string, total long"
    rows = {
        "hot": [(i, "the same long text " * 5 if i % 3 == 0 else f"text {i} é") for i in range(900)],
        "odd": [(None, None), (None, None), (None, "a"), (1, ""), (1, ""), (2, "é 漢字" * 3000), (3, "a"), (3, "a"), (-1, None)] + [(None, "same")] * 40,
        "empty": [],
    }
    con = duckdb.connect()
    if kind == "given":
        docs = spark.read.parquet(f"{small}/documents.parquet")
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    else:
        docs = spark.createDataFrame([(*r, "k", 1, "s", "t", 2) for r in rows[kind]], schema)
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        for r in rows[kind]:
            con.execute("INSERT INTO documents VALUES (?, ?)", r)
    found = sorted((tuple(r) for r in sharding.shards(docs, 16).collect()), key=str)
    assert found == sorted(con.execute(statements.SHARDING).fetchall(), key=str)
    assert len(found) == docs.count()
