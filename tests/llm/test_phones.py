"""Phone numbers of any area and exchange."""

from tidemark.llm import pii


def test_phones_of_any_area(spark):
    texts = ["call +1 (017) 555-7713 or 017-555-7713", "+1 (743) 055-3824, (000) 000-0000 and 199.199.0000", "not 0175557713"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    assert [rows[i].n_phone for i in range(3)] == [2, 3, 0]
    a, b = (x.value for x in rows[0].found)
    assert a[:4] == "+1 (" and a[4:7] + a[9:12] + a[13:] == b.replace("-", "") != "0175557713"
    assert not any(x in rows[i].text for i, x in ((0, "555-7713"), (1, "055-3824"), (1, "000) 000-0000"), (1, "199.199")))
    hidden = spark.createDataFrame([(i, r.text) for i, r in rows.items()], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.pseudonymise(hidden, "k", undo=True).collect()} == dict(enumerate(texts))
