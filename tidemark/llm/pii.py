"""Personal data: format-preserving pseudonyms by keyed Feistel networks. DataFrame functions only.

Values are found by one pattern, validated (Luhn digit, IBAN remainder, number ranges, calendar) and
replaced by a value of the same format: a Feistel network permutes the numbers that the format
allows, with round values from SHA-256 of the key, the kind and the other half. The permutation is one
to one, so equal values get equal pseudonyms in all documents and different ones differ;
with the key it can be undone. Whoever has no key can't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import lit

from .common import of_kind

ROUNDS = 8
#: One branch for each kind (fixed values); an earlier branch wins.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}"
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
DATE = r"\d{4}-\d{2}-\d{2}"
SSN = r"\d{3}-\d{2}-\d{4}"
IP = r"\d{1,3}(?:\.\d{1,3}){3}"
CARD = r"\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19}"
PHONE = r"(?:\+?1[ .-]?)?\(\d{3}\) ?\d{3}[ .-]\d{4}|\+1[ .-]?\d{3}[ .-]?\d{3}[ .-]?\d{4}|(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}"
#: A number stands alone: no letter, digit or plus sign before, no letter or digit after, also not behind a dot or hyphen.
LEFT, RIGHT = r"(?<![A-Za-z0-9_+])(?<!\d[.-])", r"(?![A-Za-z0-9_])(?![.-]\d)"
PATTERN = rf"(?<![A-Za-z0-9._%+-]){EMAIL}(?![A-Za-z0-9_])|{LEFT}(?:{IBAN}|{DATE}|{SSN}|{IP}|{CARD}|{PHONE}){RIGHT}"
KINDS = ("email", "iban", "date", "ssn", "ip", "card", "phone")
#: Dates that are permuted among themselves: DAYS days from FIRST_DAY.
FIRST_DAY, DATE_HALF = "1900-01-01", 270
DAYS = DATE_HALF * DATE_HALF


def digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def round_value(key: str, kind: str, n: int, other: Column) -> Column:
    """A keyed number below 2 ** 60."""
    return F.conv(F.substring(F.sha2(F.concat(lit(f"{key}\x1f{kind}\x1f{n}\x1f"), other.cast("string")), 256), 1, 15), 16, 10).cast("long")


def staged(value: Column, step) -> Column:
    """step(value) with value computed once: columns bound by a lambda aren't written out again and again."""
    return F.transform(F.array(value), step)[0]


def feistel_pair(a: Column, b: Column, size_a: int | Column, size_b: int | Column, key: str, kind: str, undo: bool) -> Column:
    """A permutation of the pairs (a < size_a, b < size_b), as a struct: each round moves one half by a
    keyed amount that depends on the other. Each round is bound once, so the expression grows with ROUNDS only."""
    sizes = {"a": size_a if isinstance(size_a, Column) else lit(size_a), "b": size_b if isinstance(size_b, Column) else lit(size_b)}
    pair = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    for n in reversed(range(ROUNDS)) if undo else range(ROUNDS):

        def step(n: int):
            half, other = ("a", "b") if n % 2 == 0 else ("b", "a")
            size = sizes[half]

            def moved(p: Column) -> Column:
                move = F.pmod(round_value(key, kind, n, p[other]), size)
                new = F.pmod(p[half] - move if undo else p[half] + move, size)
                return F.struct(*[(new if x == half else p[x]).alias(x) for x in ("a", "b")])

            return moved

        pair = staged(pair, step(n))
    return pair


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def into(value: Column, new_digits: Column) -> Column:
    """value with its digits replaced in order; everything else stays in place."""
    start = F.struct(lit("").alias("out"), lit(1).alias("n"))

    def step(s: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        return F.struct(F.concat(s["out"], F.when(digit, F.substring(new_digits, s["n"], lit(1))).otherwise(c)).alias("out"), (s["n"] + digit.cast("int")).alias("n"))

    return F.aggregate(F.split(value, ""), start, step, lambda s: s["out"])


def luhn_sum(numbers: Column) -> Column:
    """Luhn sum of a digit string in which the last digit counts once."""
    n = F.length(numbers)

    def part(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.pmod(n - i, lit(2)) == 0
        return F.when(twice, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.transform(F.filter(F.split(numbers, ""), lambda c: c != ""), part), lit(0), lambda s, x: s + x)


def iban_remainder(compact: Column) -> Column:
    """The number of an IBAN (first four places moved to the end, letters as 10 to 35) mod 97."""
    moved = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))

    def step(s: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code.between(48, 57), F.pmod(s * 10 + (code - 48), lit(97))).otherwise(F.pmod(s * 100 + (code - 55), lit(97)))

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), lit(0), step)


def kind_of(value: Column) -> Column:
    """The kind of a match, or null if it isn't valid."""
    d = digits(value)
    whole = lambda p: value.rlike(f"^(?:{p})$")
    octets = F.forall(F.split(value, r"\."), lambda x: x.cast("int") <= 255)
    day = F.try_to_date(value, "yyyy-MM-dd")
    ssn_area = F.substring(d, 1, 3)
    compact = F.replace(value, lit(" "), lit(""))
    return (
        F.when(F.contains(value, lit("@")), lit("email"))
        .when(whole(IBAN), F.when(F.length(compact).between(15, 34) & (iban_remainder(compact) == 1), lit("iban")))
        .when(whole(DATE), F.when((day >= lit(FIRST_DAY).cast("date")) & (day < F.date_add(lit(FIRST_DAY).cast("date"), DAYS)), lit("date")))
        .when(whole(SSN), F.when((ssn_area != "000") & (ssn_area != "666") & (ssn_area < "900") & (F.substring(d, 4, 2) != "00") & (F.substring(d, 6, 4) != "0000"), lit("ssn")))
        .when(whole(IP), F.when(octets, lit("ip")))
        .when(whole(PHONE), lit("phone"))
        .when(whole(CARD), F.when((F.substring(d, 1, 1) != "0") & (F.pmod(luhn_sum(d), lit(10)) == 0), lit("card")))
    )


def shifted(text: Column, other: Column, key: str, kind: str, n: int, undo: bool) -> Column:
    """text with each letter and digit moved within its class by a keyed byte that depends on `other`."""
    mask = F.concat(*[F.sha2(F.concat(lit(f"{key}\x1f{kind}\x1f{n}\x1f{part}\x1f"), other), 256) for part in range(2)])

    def move(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(mask, i * 2 + 1, lit(2)), 16, 10).cast("int")
        code = F.ascii(c)

        def turn(low: int, size: int) -> Column:
            return F.char(F.pmod(code - low - by if undo else code - low + by, lit(size)) + low)

        return F.when(c.between("0", "9"), turn(48, 10)).when(c.between("a", "z"), turn(97, 26)).when(c.between("A", "Z"), turn(65, 26)).otherwise(c)

    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), move), "")


def renamed(value: Column, key: str, kind: str, undo: bool) -> Column:
    """A string's two halves move each other's letters and digits within their classes: a Feistel
    network on text of any length up to 128. One of a single character is moved by the key alone."""
    middle = F.floor(F.length(value) / 2).cast("int")
    pair = F.struct(F.substring(value, lit(1), middle).alias("a"), F.substring(value, middle + 1, F.length(value)).alias("b"))
    for n in reversed(range(4)) if undo else range(4):

        def step(n: int):
            half, other = ("b", "a") if n % 2 == 0 else ("a", "b")
            return lambda p: F.struct(*[(shifted(p[half], p[other], key, kind, n, undo) if x == half else p[x]).alias(x) for x in ("a", "b")])

        pair = staged(pair, step(n))
    return staged(pair, lambda p: F.concat(p["a"], p["b"]))


def pseudonym(value: Column, key: str, undo: bool = False) -> Column:
    """A valid value's stand-in of the same format (the value itself if kind_of is null). undo: the way back."""
    d = digits(value)

    # A card keeps its first digit; the others but the check digit are permuted, for each length apart.
    inner = F.length(d) - 2
    left = F.floor(inner / 2).cast("int")
    power = lambda n: F.element_at(F.array(*[lit(10**k) for k in range(1, 10)]), n)

    def card(pair: Column) -> Column:
        body = F.concat(F.substring(d, 1, 1), F.lpad(pair["a"].cast("string"), left, lit("0")), F.lpad(pair["b"].cast("string"), inner - left, lit("0")))
        return staged(body, lambda x: into(value, F.concat(x, F.pmod(10 - F.pmod(luhn_sum(F.concat(x, lit("0"))), lit(10)), lit(10)).cast("string"))))

    cards = staged(feistel_pair(F.substring(d, lit(2), left), F.substring(d, left + 2, inner - left), power(left), power(inner - left), key, "card", undo), card)
    octet = [F.split(value, r"\.")[k].cast("long") for k in range(4)]
    ip = staged(
        feistel_pair(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], 65536, 65536, key, "ip", undo),
        lambda p: F.concat_ws(".", *[F.pmod(F.floor(p[half] / by), lit(256)).cast("string") for half in ("a", "b") for by in (256, 1)]),
    )
    days = F.datediff(F.try_to_date(value, "yyyy-MM-dd"), lit(FIRST_DAY).cast("date"))
    date = staged(feistel_pair(F.floor(days / DATE_HALF), F.pmod(days, lit(DATE_HALF)), DATE_HALF, DATE_HALF, key, "date", undo), lambda p: F.date_add(lit(FIRST_DAY).cast("date"), (p["a"] * DATE_HALF + p["b"]).cast("int")).cast("string"))
    ten = F.right(d, lit(10))
    part = lambda s, at, n: F.substring(s, at, n).cast("long")
    phone = staged(
        feistel_pair(part(ten, 1, 5), part(ten, 6, 5), 100_000, 100_000, key, "phone", undo),
        lambda p: into(value, F.concat(F.substring(d, lit(1), F.length(d) - 10), padded(p["a"], 5), padded(p["b"], 5))),
    )
    area = part(d, 1, 3)
    areas = F.when(area > 666, area - 2).otherwise(area - 1)  # 898 areas: 001 to 899 without 666
    ssn = staged(
        feistel_pair(areas * 99 + part(d, 4, 2) - 1, part(d, 6, 4) - 1, 898 * 99, 9999, key, "ssn", undo),
        lambda p: staged(F.floor(p["a"] / 99) + 1, lambda x: F.concat(padded(F.when(x >= 666, x + 1).otherwise(x), 3), lit("-"), padded(F.pmod(p["a"], lit(99)) + 1, 2), lit("-"), padded(p["b"] + 1, 4))),
    )
    compact = F.replace(value, lit(" "), lit(""))
    country = F.substring(compact, 1, 2)

    def spaced(new: Column) -> Column:
        start = F.struct(lit("").alias("out"), lit(1).alias("n"))
        return F.aggregate(
            F.filter(F.split(value, ""), lambda c: c != ""), start,
            lambda s, c: F.struct(F.concat(s["out"], F.when(c == " ", c).otherwise(F.substring(new, s["n"], lit(1)))).alias("out"), (s["n"] + (c != " ").cast("int")).alias("n")),
            lambda s: s["out"],
        )

    iban = staged(
        renamed(F.substring(compact, 5, 40), key, "iban", undo),
        lambda bban: staged(F.concat(country, padded(98 - iban_remainder(F.concat(country, lit("00"), bban)), 2), bban), spaced),
    )
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    email = F.concat(renamed(local, key, "email", undo), lit("@"), domain)
    kind = kind_of(value)
    return F.when(kind == "email", email).when(kind == "iban", iban).when(kind == "date", date).when(kind == "ssn", ssn).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "card", cards).otherwise(value)


def pseudonymise(docs: DataFrame, key: str, undo: bool = False) -> DataFrame:
    """doc_id, text with every valid value replaced, n_<kind> for each kind, n_pii, found (array of
    kind and pseudonym in order). Null texts stay null and empty ones empty, with counts of 0;
    matches that don't validate stay as they are; repeated rows come back as often; an empty table
    gives none. Columns of docs other than doc_id and text aren't read. With undo the same key gives
    the first texts back."""
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    match_type = "array<struct<kind: string, value: string>>"
    some = text.rlike(r"@|\d")
    values = F.when(some, F.regexp_extract_all(text, lit(PATTERN), 0))
    found = F.transform(values, lambda v: F.struct(kind_of(v).alias("kind"), pseudonym(v, key, undo).alias("value"))).cast(match_type)
    # The matches are evaluated in a projection of their own; rows without any keep null.
    step = rows.withColumn("all", F.when(F.size(values) > 0, found))
    between = F.split(text, PATTERN, -1)
    merged = F.array_join(F.flatten(F.zip_with(between, F.transform("all", lambda x: x["value"]), lambda a, b: F.array(a, F.coalesce(b, lit(""))))), "")
    known = F.coalesce(F.filter("all", lambda x: x["kind"].isNotNull()), F.array().cast(match_type))
    counts = [F.size(F.filter("found", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return step.select("doc_id", F.when(F.col("all").isNull(), text).otherwise(merged).alias("text"), known.alias("found")).select("doc_id", "text", *counts, F.size("found").cast("long").alias("n_pii"), "found")
