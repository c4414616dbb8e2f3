"""Secret scanning: fixed patterns, and an assignment-aware lexer.

The lexer reads source and configuration syntax line by line: `name = "literal"`, `name: literal`,
`"name": "literal"`, `export NAME=literal`, `--name=literal`, string concatenation and names
that stand for earlier literals. A literal is scored by how sensitive its target's name is and
by its own spread of characters; spans from `MIN_SCORE` on are reported. A name that stands for others
refers to them and keeps a digest of bounded size of the whole value, so that time and memory follow the text's
length even where its values double with each line.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import small_batches

#: Base patterns (fixed values): kind, pattern, group whose length counts, least length.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)
#: For kinds with one character class a run that is long enough is found directly.
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
#: Weights of words in a target's name (fixed values).
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "pass": 0.6, "secret": 1.0, "token": 0.9, "apikey": 1.0, "key": 0.5, "api": 0.4, "private": 0.4, "access": 0.4, "auth": 0.6, "authorization": 0.7, "bearer": 0.8, "credential": 0.8, "credentials": 0.8, "cred": 0.6, "creds": 0.7, "signing": 0.4, "encryption": 0.4, "client": 0.2, "session": 0.3, "cookie": 0.3, "webhook": 0.4, "dsn": 0.5, "conn": 0.3, "connection": 0.3, "salt": 0.4}
#: Literals that stand in for a secret (fixed values).
PLACEHOLDERS = re.compile(r"(?i)^(x+|\*+|\.+|-+|changeme|example|placeholder|none|null|true|false|undefined|todo|test|password|secret|token|your[-_ ].*|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|%[A-Za-z_]+%)$")
MIN_SCORE = 0.6
MIN_LITERAL = 8
#: Characters of a value's beginning and end that its digest keeps.
ENDS = 64
#: A word of a line: name, string, operator. A quote that nothing closes is a word of its own: none of
#: its kind closes further on either, so the lexers of the rest of the line don't look for one.
NAME, OPERATOR, BARE = r"""(?P<name>--?[A-Za-z][\w.-]*|[A-Za-z_$][\w.$-]*(?:\[\s*(?:"[^"\n]*"|'[^'\n]*')\s*\])?)""", r"(?P<op>:=|=>|==|!=|<=|>=|\+=|[=:+,;(){}\[\]])", r"""(?P<bare>[^\s"'`=:+,;(){}\[\]]+)"""
STRINGS = {'"': r'"(?P<double>(?:[^"\\\n]|\\.)*)"', "'": r"'(?P<single>(?:[^'\\\n]|\\.)*)'", "`": "`(?P<back>[^`\n]*)`"}
CANDIDATE = re.compile(r"[=:]")
UNQUOTED = re.compile(r"""[^\s,;"'(){}\[\]]+""")


@cache
def lexer(quotes: str) -> re.Pattern:
    """Words of a line in which only these quotes may still close."""
    return re.compile("|".join([NAME, *[STRINGS[q] for q in quotes], OPERATOR, BARE, *(["(?P<open>[" + quotes + "])"] if quotes else [])]))


def lex(line: str) -> list[tuple[str, str, int, int]]:
    """(kind, word, start, end)."""
    out, quotes, at = [], "\"'`", 0
    while True:
        for m in lexer(quotes).finditer(line, at):
            kind = m.lastgroup
            if kind == "open":
                quotes, at = quotes.replace(m[0], ""), m.end()
                break
            out.append((kind, m[kind], m.start(kind), m.end(kind)))
        else:
            return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, order of the kind, end): the whole match, where the measured group is long enough."""
    found = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        if kind == "access" and "AKIA" not in text:
            continue
        for m in (LONG_HEX if kind == "hex" else pattern).finditer(text):
            if len(m[group]) >= least:
                found.append((m.start(), order, m.end()))
    return sorted(found)


def sensitivity(name: str) -> float:
    """0 to 1: the words of a camel-case, snake-case or dotted name, combined as independent evidence."""
    parts = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()
    miss = 1.0
    for word in filter(None, re.split(r"[^a-z0-9]+", parts)):
        miss *= 1 - SENSITIVE.get(word.rstrip("0123456789"), SENSITIVE.get(word, 0.0)) if word not in ("count", "length", "len", "max", "min", "size", "limit", "field", "label") else 2.0
    if miss > 1:  # max_tokens, token_count
        return 0.0
    return 1 - miss


class Value:
    """A literal (text, start, end) or the values it is joined of, and a digest of the whole: length, share of
    each character (of non-ASCII ones by their last eight bits), spaces (four at most), first and last characters."""

    __slots__ = ("parts", "span", "length", "shares", "spaces", "head", "tail", "reported")

    def __init__(self, text: str = "", start: int = 0, end: int = 0, parts: list[Value] | None = None):
        self.parts, self.span, self.reported = parts, (start, end), False
        if parts is None:
            self.length, self.spaces, self.head, self.tail = float(len(text)), min(4, text.count(" ")), text[:ENDS], text[ENDS:][-ENDS:]
            self.shares = Counter(c if c < "\x80" else chr(0x100 | ord(c) & 255) for c in text)
            for c in self.shares:
                self.shares[c] /= self.length
            return
        self.length = min(1e300, sum(p.length for p in parts))
        self.spaces = min(4, sum(p.spaces for p in parts))
        self.head, self.tail, self.shares = "", "", Counter()
        for p in parts:
            whole = self.head + self.tail + p.head if len(self.head) < ENDS else self.head
            self.tail = (self.tail + p.head + p.tail)[-ENDS:] if len(self.head) >= ENDS else (whole[ENDS:] + p.tail)[-ENDS:]
            self.head = whole[:ENDS]
            for c, share in p.shares.items():
                self.shares[c] += share * p.length / self.length if self.length else 0.0

    def digest(self) -> str:
        """The value, its middle cut down to the characters that occur nowhere else if it is long."""
        if self.length <= 2 * ENDS:
            return self.head + self.tail
        return self.head + "".join(sorted(set(self.shares) - set(self.head) - set(self.tail))) + self.tail

    def entropy(self) -> float:
        """Bits for each character."""
        return -sum(p * math.log2(p) for p in self.shares.values() if p > 0)

    def spans(self) -> Iterator[tuple[int, int]]:
        """The spans of its literals that haven't been asked for before: each is given once in all."""
        stack = [self]
        while stack:
            x = stack.pop()
            if x.reported:
                continue
            x.reported = True
            if x.parts is None:
                yield x.span
            else:
                stack.extend(x.parts)


def score(name: str, value: Value) -> float:
    """Sensitivity of the name, times how random the literal looks."""
    if value.length < MIN_LITERAL or value.spaces > 3 or PLACEHOLDERS.match(value.digest()):
        return 0.0
    mixed = sum(any(map(test, value.shares)) for test in (ascii_lower, ascii_upper, str.isdigit, other_sign))
    return sensitivity(name) * min(1.0, value.entropy() / 3.0 * (0.7 + 0.15 * mixed))


def ascii_lower(c: str) -> bool:
    return "a" <= c <= "z"


def ascii_upper(c: str) -> bool:
    return "A" <= c <= "Z"


def other_sign(c: str) -> bool:
    return c < "\x80" and not c.isalnum() and c != "_" and not c.isspace()


def assigned(text: str) -> Iterator[tuple[str, Value]]:
    """(name, its literal): a literal may be joined of several, and a name may stand for literals
    given to it before (propagated until it is given another value)."""
    constants: dict[str, Value] = {}
    at = 0
    for line in text.split("\n"):
        if CANDIDATE.search(line):
            words = lex(line)
            k = 0
            while k + 1 < len(words):
                kind, name, *_ = words[k]
                if kind not in ("name", "double", "single") or words[k + 1][0] != "op" or words[k + 1][1] not in ("=", ":", ":=", "=>", "+="):
                    k += 1
                    continue
                j, parts = k + 2, []
                while j < len(words):
                    kind, word, a, b = words[j]
                    if kind in ("double", "single", "back"):
                        parts.append(Value(word, at + a, at + b))
                    elif kind == "name" and word in constants and (j + 1 >= len(words) or words[j + 1][0] == "op" and words[j + 1][1] in "+,;)}"):
                        parts.append(constants[word])
                    elif kind in ("bare", "name") and not any(p.length for p in parts) and words[k + 1][1] in ("=", ":") and (j + 1 >= len(words) or words[j + 1][1] not in ("(", "=", ":")):
                        if end := UNQUOTED.match(line, a):  # an unquoted literal runs to a delimiter
                            parts = [Value(end[0], at + a, at + end.end())]
                            while j + 1 < len(words) and words[j + 1][2] < end.end():
                                j += 1
                    else:
                        break
                    j += 1
                    if j < len(words) and words[j][0] == "op" and words[j][1] == "+":
                        j += 1
                        continue
                    break
                if parts:
                    plain = name.lstrip("-")
                    if words[k + 1][1] == "+=" and plain in constants:
                        parts = [constants[plain], *parts]
                    constants[plain] = parts[0] if len(parts) == 1 else Value(parts=parts)
                    yield plain, constants[plain]
                    k = j
                else:
                    k += 1
        at += len(line) + 1


def scan(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans) as (start, end, kind), in order of start, then of the kinds assign,
    access, hex, literal. Offsets are code points, ends exclusive."""
    if not text:
        return [], []
    kinds = [k for k, *_ in BASE] + ["literal"]
    base = base_spans(text)
    found = set(base)
    if CANDIDATE.search(text):
        for name, value in assigned(text):
            if sensitivity(name) >= MIN_SCORE and score(name, value) >= MIN_SCORE:  # no literal scores more than its name
                found |= {(a, len(BASE), b) for a, b in value.spans() if b > a}
    return [(a, b, kinds[k]) for a, k, b in base], [(a, b, kinds[k]) for a, k, b in sorted(found)]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base, spans: arrays of (start, end, kind) in each whole text, base ones and all.
    Null and empty texts have none; repeated rows come back as often; other columns aren't read."""
    small_batches(docs.sparkSession)
    item = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])

    def rows(found):
        return pa.array([[{"start": a, "end": b, "kind": k} for a, b, k in x] for x in found], pa.list_(item))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [scan(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), rows(x for x, _ in found), rows(x for _, x in found)], ["doc_id", "base", "spans"])

    kind = "array<struct<start: bigint, end: bigint, kind: string>>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"doc_id long, base {kind}, spans {kind}")


def redact(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with every span replaced; overlapping spans count as one."""
    out, at = [], 0
    spans = scan(text)[1]
    if not spans:
        return text
    for a, b, _ in spans:
        if a > at or not out and a == 0:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """docs with the secrets of `text` replaced; all rows and columns stay."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.set_column(at, "text", pa.array([redact(t) for t in b.column(at).to_pylist()], pa.string()))

    return docs.mapInArrow(run, docs.schema)


def digest(base: str) -> str:
    return hashlib.sha256(base.encode()).hexdigest()
