"""Rows that are odd in one way or another, through whole operators and queries."""

import hashlib

import pytest

from tidemark.llm import decontaminate, queries, secrets_scan

ITEM = "the quick brown fox jumps over the lazy dog while seven grey geese watch from the old stone bridge"
CONVERSATION = "conv_id long, turn int, role string, text string"


def chat(spark, folder, rows, schema=CONVERSATION):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/conversations.parquet")
    return {r.conv_id: r for r in queries.op5_chat_formatting(spark, str(folder)).collect()}


def turns(*pairs):
    return hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in pairs).encode()).hexdigest()


def test_no_conversations(spark, tmp_path):
    got = chat(spark, tmp_path, [])
    assert list(got) == [-1] and got[-1].n_turns == 2 and got[-1].loss_chars == 21


def test_conversations_without_id_and_clashing_columns(spark, tmp_path):
    rows = [(None, 1, "user", "ask", "x", 1, "y"), (None, 2, "assistant", None, "x", 1, "y"), (7, 1, "user", "", "x", 1, "y"), (7, 2, "assistant", "<|end|>\\<[", "x", 1, "y")]
    got = chat(spark, tmp_path, rows, CONVERSATION + ", messages string, record int, formatted string")
    assert set(got) == {-1, None, 7}
    assert got[None].turns_sha256 == turns(("user", "ask"), ("assistant", "")) and got[None].loss_chars == 0
    assert got[7].turns_sha256 == turns(("user", ""), ("assistant", "<|end|>\\<[")) and got[7].loss_chars == 10


@pytest.fixture()
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM, "a"), (2, None, "a"), (3, "", "a"), (None, ITEM, "a")], "item_id long, text string, score string")


def test_contaminated_odd(spark, benchmark):
    long = "filler words " * 50_000 + ITEM.upper().replace(" ", ", ") + " more" * 50_000
    rows = [(None, f"so {ITEM} end", 1.0, 2), (5, long, 1.0, 2), (6, ITEM, 1.0, 2), (6, ITEM, 1.0, 2), (7, None, 1.0, 2), (8, "", 1.0, 2), (9, "the quick brown hare sleeps", 1.0, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, item_id int")
    found = decontaminate.contaminated(docs, benchmark).collect()
    assert sorted(((r.doc_id, r.item_id) for r in found), key=str) == sorted([(d, i) for d in (None, 5, 6, 6) for i in (1, None)], key=str)
    assert {r.score for r in found} == {1.0}
    assert {(r.first_word, r.end_word) for r in found if r.doc_id == 5} == {(100_000, 100_000 + len(ITEM.split()))}
    left = decontaminate.clean(docs, benchmark)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [7, 8, 9]
    assert decontaminate.contaminated(docs.where("false"), benchmark).collect() == []
    assert decontaminate.contaminated(docs, benchmark.where("false")).collect() == []


def test_secrets_in_a_very_long_text(spark):
    text = "x = 1\n" * 60_000 + "é password = 'correcthorse9battery'\n" + "y" * 200_000
    rows = spark.createDataFrame([(1, text, "a"), (None, text, "a"), (1, text, "a")], "doc_id long, text string, spans string")
    found = secrets_scan.find_secrets(rows).collect()
    assert len(found) == 3
    for r in found:
        base = [(x.kind, text[x.start : x.end]) for x in r.base]
        assert len(base) == 1 and base[0][0] == "assign" and "correcthorse9battery" in base[0][1]
