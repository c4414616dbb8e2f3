"""Assignments through constants in very long texts."""

from tidemark.llm import secrets_scan


def test_constant_before_ten_thousand_names():
    text = 'first = "Zx81-qqPLm!0"\n' + "".join(f"n{i} = {i}\n" for i in range(10_500)) + "db_password = first"
    assert [text[a:b] for a, b, kind in secrets_scan.scan(text)[1] if kind == "literal"] == ["Zx81-qqPLm!0"]


def test_chain_of_names_takes_room_in_proportion():
    text = 'n0 = "Zx81-qqPLm!0"\n' + "".join(f'n{i + 1} = n{i} + "{chr(97 + i % 26)}"\n' for i in range(20_000)) + "db_password = n20000"
    assert len([1 for *_, kind in secrets_scan.scan(text)[1] if kind == "literal"]) == 20_001
