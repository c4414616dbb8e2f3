"""Chat formatting: heterogeneous layouts to canonical turns to one marked text. DataFrame functions only.

A record's schema fingerprint is the hash of the sorted nested paths of its fields that hold a
value; it selects a declarative mapping. A mapping is either a list of (role, path) pairs or the path
of an array of messages with the fields of role and text. Turns are then put into a template
whose control strings can't occur in a text: after each `<` and `[` of a text a
backslash is inserted, and taking it out again gives the text back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T
from pyspark.sql.functions import lit

START, END = "<|turn|>", "<|end|>"


@dataclass(frozen=True)
class Mapping:
    """paths: the leaf paths that a record of this layout fills (`messages[].role`). turns: (role, path)
    in order, or messages: (array path, field of role, field of text)."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    messages: tuple[str, str, str] | None = None


#: Layouts known from the start; callers may pass their own.
MAPPINGS = (
    Mapping("messages", ("messages[].content", "messages[].role"), messages=("messages", "role", "content")),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), messages=("conversations", "from", "value")),
    Mapping("messages_from", ("messages[].from", "messages[].value"), messages=("messages", "from", "value")),
    Mapping("conversations_role", ("conversations[].content", "conversations[].role"), messages=("conversations", "role", "content")),
    Mapping("prompt", ("prompt", "response"), turns=(("user", "prompt"), ("assistant", "response"))),
    Mapping("completion", ("completion", "prompt"), turns=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("instruction", ("instruction", "output"), turns=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", ("input", "instruction", "output"), turns=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("system_prompt", ("prompt", "response", "system"), turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("question", ("answer", "question"), turns=(("user", "question"), ("assistant", "answer"))),
)
#: Names of roles that mean one of the canonical ones (fixed values).
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def leaf_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """All leaf paths of a type: `a.b` for structs, `a[].b` for arrays of structs."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in leaf_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return leaf_paths(kind.elementType, prefix + "[]")
    return [prefix]


def filled(value: Column, path: str) -> Column:
    """Whether the record holds a value at this path; of an array: in any of its elements."""
    head, array, rest = path.partition("[]")
    for name in filter(None, head.split(".")):
        value = value[name]
    if not array:
        return value.isNotNull()
    return F.coalesce(F.exists(value, lambda x: filled(x, rest.removeprefix("."))), lit(False))


def schema_fingerprint(record: str, kind: T.StructType) -> Column:
    """Hash of the sorted leaf paths at which the struct column `record` holds a value, judged for each record."""
    found = F.array(*[F.when(filled(F.col(record), p), lit(p)) for p in sorted(leaf_paths(kind))])
    return F.xxhash64(F.array_join(F.array_compact(found), "\n"))


def is_empty(record: str, kind: T.StructType) -> Column:
    """Whether an array of messages is there but has no element, and nothing else is."""
    arrays = [F.coalesce(F.size(F.col(f"{record}.{f.name}")) == 0, lit(False)) for f in kind.fields if isinstance(f.dataType, T.ArrayType)]
    some = lit(False)
    for a in arrays:
        some = some | a
    return some & (schema_fingerprint(record, kind) == F.xxhash64(lit("")))


def message(role: str, text: str):
    """What makes a turn of a message whose fields have these names."""
    return lambda x: F.struct(x[role].cast("string").alias("role"), x[text].cast("string").alias("text"))


def canonical_turns(records: DataFrame, id_col: str, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """conv_id, turn, role, text, layout: the turns of each record by the mapping that its fingerprint
    selects. Null texts are empty, null roles too, also where all texts of a record are null; a record of no known
    layout gives one row with layout null and turn null, so nothing is lost unseen; a record without messages
    gives no turn. A null id, repeated and clashing columns pass: only id_col and record are read."""
    kind = records.schema[record].dataType
    names = set(leaf_paths(kind))
    fingerprint = schema_fingerprint(record, kind)
    turn_type = "array<struct<role: string, text: string>>"
    turns, layout = F.expr(f"cast(null as {turn_type})"), lit(None).cast("string")
    for m in mappings:
        if not set(m.paths) <= names:
            continue
        fits = fingerprint == F.xxhash64(lit("\n".join(sorted(m.paths))))
        if m.messages:
            fits |= fingerprint == F.xxhash64(lit(f"{m.messages[0]}[].{m.messages[1]}"))  # roles alone: all texts are null
        if m.messages:
            array, role, text = m.messages
            made = F.transform(F.col(f"{record}.{array}"), message(role, text))
        else:
            made = F.array(*[F.struct(lit(r).alias("role"), F.col(f"{record}.{p}").cast("string").alias("text")) for r, p in m.turns])
        turns = F.when(fits, made.cast(turn_type)).otherwise(turns)
        layout = F.when(fits, lit(m.name)).otherwise(layout)
    layout = F.when(is_empty(record, kind), lit("empty")).otherwise(layout)
    role = F.coalesce("t.role", lit(""))
    for other, canonical in ROLES.items():
        role = F.when(F.col("t.role") == other, lit(canonical)).otherwise(role)
    seen = records.select(F.col(id_col).alias("conv_id"), turns.alias("turns"), layout.alias("layout"))
    known = seen.where("layout is not null").select("conv_id", "layout", F.posexplode("turns").alias("turn", "t")).select("conv_id", F.col("turn").cast("long"), role.alias("role"), F.coalesce("t.text", lit("")).alias("text"), "layout")
    unknown = seen.where("layout is null").select("conv_id", lit(None).cast("long").alias("turn"), lit("").alias("role"), lit("").alias("text"), "layout")
    return known.union(unknown)


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, lit("<"), lit("<\\")), lit("["), lit("[\\"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, lit("[\\"), lit("[")), lit("<\\"), lit("<"))


def escape_role(role: Column) -> Column:
    """A role is one line: backslashes and line feeds are written as escapes."""
    return escape(F.replace(F.replace(role, lit("\\"), lit("\\\\")), lit("\n"), lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(unescape(role), lit("\\\\"), lit("\\\x00")), lit("\\n"), lit("\n")), lit("\\\x00"), lit("\\"))


def format_chat(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss (array of start, end in code points: the escaped texts of loss_role's
    turns). turns: conv_id, turn, role, text, perhaps layout (rows without one are no turns and left out); equal
    turn numbers are ordered by role and text. Offsets are running sums in a window, so a conversation costs
    time in proportion to its length. Null ids form one conversation; an empty table gives no rows."""
    if "layout" in turns.columns:
        turns = turns.where("layout is not null")
    head = F.concat(lit(START), escape_role(F.coalesce("role", lit(""))), lit("\n"))
    body = escape(F.coalesce("text", lit("")))
    pieces = turns.select("conv_id", "turn", F.coalesce("role", lit("")).alias("role"), F.length(head).cast("long").alias("lead"), F.length(body).cast("long").alias("size"), F.concat(head, body, lit(END + "\n")).alias("piece"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "piece")
    start = F.coalesce(F.sum(F.col("lead") + F.col("size") + len(END) + 1).over(order.rowsBetween(W.unboundedPreceding, -1)), lit(0)) + F.col("lead")
    placed = pieces.select("conv_id", F.row_number().over(order).alias("n"), "piece", F.when(F.col("role") == loss_role, F.struct(start.alias("start"), (start + F.col("size")).alias("end"))).alias("loss"))
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("n", "piece", "loss"))).alias("all"))
    return whole.select("conv_id", F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("formatted"), F.filter(F.transform("all", lambda x: x["loss"]), lambda x: x.isNotNull()).alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text holds."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>", -1), lambda x: x != "")

    def turn(piece: Column) -> Column:
        cut = F.locate("\n", piece)
        role = F.substring(piece, lit(1), cut - 1)
        text = F.substring(piece, cut + 1, F.length(piece) - cut - lit(len(END) + 1))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def masked(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda x: unescape(F.substring(formatted, (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int")))), "")
