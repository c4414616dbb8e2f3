"""The whole query of pseudonyms against a plain version of it, value by value, and its odd rows."""

import hashlib
import random
import re
from datetime import date, timedelta

import pytest

from tidemark.llm import pii, queries

FIRST = date(1900, 1, 1)


def luhn(d):
    return sum(x if (len(d) - i) % 2 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, d)))


def mod97(compact):
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97


def plain_kind(v):
    d = re.sub(r"[^0-9]", "", v)
    whole = lambda p: re.fullmatch(p, v, re.ASCII)
    if "@" in v:
        return "email"
    if whole(pii.IBAN):
        compact = v.replace(" ", "")
        return "iban" if 15 <= len(compact) <= 34 and mod97(compact) == 1 else None
    if whole(pii.DATE):
        try:
            return "date" if 0 <= (date.fromisoformat(v) - FIRST).days < 270 * 270 else None
        except ValueError:
            return None
    if whole(pii.SSN):
        return "ssn" if d[:3] not in ("000", "666") and d[:3] < "900" and d[3:5] != "00" and d[5:] != "0000" else None
    if whole(pii.IP):
        return "ip" if all(int(x) <= 255 for x in v.split(".")) else None
    if whole(pii.PHONE):
        return "phone"
    return "card" if d[0] != "0" and luhn(d) % 10 == 0 else None


def plain_feistel(a, b, size_a, size_b, key, kind):
    pair, sizes = [a, b], [size_a, size_b]
    for n in range(8):
        half = n % 2
        move = int(hashlib.sha256(f"{key}\x1f{kind}\x1f{n}\x1f{pair[1 - half]}".encode()).hexdigest()[:15], 16)
        pair[half] = (pair[half] + move) % sizes[half]
    return pair


def plain_name(value, key, kind):
    pair = [value[: len(value) // 2], value[len(value) // 2 :]]
    for n in range(4):
        half = 1 - n % 2
        mask = "".join(hashlib.sha256(f"{key}\x1f{kind}\x1f{n}\x1f{part}\x1f{pair[1 - half]}".encode()).hexdigest() for part in range(2))
        new = ""
        for i, c in enumerate(pair[half]):
            by = int(mask[2 * i : 2 * i + 2], 16)
            for first, size in (("0", 10), ("a", 26), ("A", 26)):
                if 0 <= ord(c) - ord(first) < size:
                    c = chr((ord(c) - ord(first) + by) % size + ord(first))
                    break
            new += c
        pair[half] = new
    return "".join(pair)


def put(value, new, takes):
    """new's characters in order where takes holds; the others of value stay."""
    left = iter(new)
    return "".join(next(left) if takes(c) else c for c in value)


def plain_value(v, kind, key):
    d, digit = re.sub(r"[^0-9]", "", v), lambda c: "0" <= c <= "9"
    if kind == "email":
        local, domain = v.split("@")
        return plain_name(local, key, kind) + "@" + domain
    if kind == "iban":
        compact = v.replace(" ", "")
        rest = plain_name(compact[4:], key, kind)
        return put(v, f"{compact[:2]}{98 - mod97(compact[:2] + '00' + rest):02d}{rest}", lambda c: c != " ")
    if kind == "date":
        days = (date.fromisoformat(v) - FIRST).days
        a, b = plain_feistel(days // 270, days % 270, 270, 270, key, kind)
        return str(FIRST + timedelta(a * 270 + b))
    if kind == "ssn":
        area = int(d[:3])
        a, b = plain_feistel((area - 1 - (area > 666)) * 99 + int(d[3:5]) - 1, int(d[5:]) - 1, 898 * 99, 9999, key, kind)
        area = a // 99 + 1
        return f"{area + (area >= 666):03d}-{a % 99 + 1:02d}-{b + 1:04d}"
    if kind == "ip":
        o = [int(x) for x in v.split(".")]
        a, b = plain_feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, kind)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if kind == "phone":
        a, b = plain_feistel(int(d[-10:-5]), int(d[-5:]), 100_000, 100_000, key, kind)
        return put(v, f"{d[:-10]}{a:05d}{b:05d}", digit)
    left, right = (len(d) - 2) // 2, len(d) - 2 - (len(d) - 2) // 2
    a, b = plain_feistel(int(d[1 : 1 + left]), int(d[1 + left : -1]), 10**left, 10**right, key, kind)
    body = f"{d[0]}{a:0{left}d}{b:0{right}d}"
    return put(v, f"{body}{-luhn(body + '0') % 10}", digit)


def plain(text, key):
    """The new text and (kind, pseudonym) of its valid values."""
    found = []

    def one(m):
        kind = plain_kind(m[0])
        if kind is None:
            return m[0]
        found.append((kind, plain_value(m[0], kind, key)))
        return found[-1][1]

    return None if text is None else re.sub(pii.PATTERN, one, text, flags=re.ASCII), found


def same(rows, texts, key):
    """rows of the operator are as the plain version has them, for each text by its id; the counts agree."""
    assert len(rows) == len(texts)
    for r in rows:
        text, found = plain(texts[r.doc_id], key)
        assert (r.text, [(x.kind, x.value) for x in r.found]) == (text, found)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(k == x for x, _ in found) for k in pii.KINDS] and r.n_pii == len(found)


def test_whole_query(spark, small):
    texts = {r.doc_id: r.text for r in queries.table(spark, small, "documents").collect()}
    rows = queries.op8_pii(spark, small).collect()
    same(rows, texts, queries.DEMO_KEY)
    assert sum(r.n_pii for r in rows) > 0


def made_values(rng):
    """A value of each kind, valid or not by chance."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    body = rng.choice("123456789") + n(rng.randint(11, 17))
    card = body + str(-luhn(body + "0") % 10)
    bank = "".join(rng.choice("ABCXYZ0123456789") for _ in range(rng.randint(11, 24)))
    iban = f"DE{98 - mod97('DE00' + bank):02d}{bank}"
    spaced = lambda x: " ".join(x[i : i + 4] for i in range(0, len(x), 4))
    return [
        rng.choice([card, card[:-1] + "0", spaced(card)]), rng.choice([iban, spaced(iban), iban[:-1] + "7"]), f"{rng.choice(['1899', '1900', '1984', '2099', '2100'])}-{rng.randint(0, 13):02d}-{rng.randint(0, 32):02d}",
        f"{rng.choice(['000', '001', '665', '666', '667', '899', '900'])}-{n(2)}-{n(4)}", ".".join(str(rng.randint(0, 299)) for _ in range(4)), rng.choice([f"({n(3)}) {n(3)}-{n(4)}", f"+1 {n(3)} {n(3)} {n(4)}", f"{n(3)}.{n(3)}.{n(4)}"]),
        f"{rng.choice(['a', 'Jo.Doe', 'x_9%z', 'q' * 64, 'r' * 65])}@{rng.choice(['b.org', 'mail.example.co', 'b'])}",
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_made_values(spark, seed):
    rng = random.Random(seed)
    texts = {}
    for i in range(120):
        values = made_values(rng)
        rng.shuffle(values)
        texts[i] = "".join(rng.choice(["", " ", ", ", "é", "\n", "#"]) + v + rng.choice([" ", ".", "; ", "\t", "x"]) for v in values)
    rows = pii.pseudonymise(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "k").collect()
    same(rows, texts, "k")
    assert {x.kind for r in rows for x in r.found} == set(pii.KINDS)


def test_odd_rows(spark):
    long = "word " * 100_000 + "+1 (017) 555-7713 " + "x" * 100_000 + " 192.168.0.1"
    rows = [(1, None, 9, "a"), (2, "", 9, "a"), (3, long, 9, "a"), (None, "at 1984-02-29", 9, "a"), (4, "a@b.org", 9, "a"), (4, "a@b.org", 9, "a")]
    out = pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string, n_pii int, found string").repartition(3), "k")
    assert out.columns == ["doc_id", "text", *[f"n_{k}" for k in pii.KINDS], "n_pii", "found"]
    got = sorted(((r.doc_id, r.text, r.n_pii) for r in out.collect()), key=str)
    assert got == sorted(((i, plain(t, "k")[0], len(plain(t, "k")[1])) for i, t, *_ in rows), key=str)
