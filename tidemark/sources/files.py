"""Files in and out: sources with detected schemas, flexible dates, events."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.functions import lit

from .canon import NO_PROPERTY

#: Names that a role's column may have, after lower-casing and underscores (fixed values).
HINTS = {
    "property": ("property", "propiedad", "hotel", "hotel_code", "property_code"),
    "date": ("stay_date", "business_date", "fecha", "date", "stay"),
    "demand": ("rooms_sold", "room_nights", "rn", "realized_rn", "rooms"),
    "capacity": ("capacity", "available_rooms", "inventory", "oficial_inventory", "official_inventory"),
    "pickup": ("pickup_rn", "rooms_booked", "booked_rn", "booked", "otb"),
    "lead": ("lead_days", "lead", "days_out"),
    "snapshot": ("snapshot_date", "snap", "snapshot", "snapshotdate"),
}
DERIVED = "__derived__"
SAMPLE = 20
DATE_SHARE = 0.9


class SchemaDetectionError(ValueError):
    """A role that a source needs has no column."""


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """CSV files are read as text (types follow from roles); everything else is Parquet."""
    return spark.read.option("header", True).csv(path) if path.lower().split("?")[0].endswith((".csv", ".csv.gz")) else spark.read.parquet(path)


def date_layout(df: DataFrame, column: str, prefer_day_first: bool = True) -> str:
    """'date', 'iso', 'day_first', 'month_first' or 'unknown': one aggregation over the column."""
    if isinstance(df.schema[column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    c = F.trim(F.col(column).cast("string"))
    slash = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    part = lambda k: F.expr(f"try_cast(regexp_extract(trim(cast(`{column}` as string)), '^(\\\\d{{1,2}})/(\\\\d{{1,2}})/(\\\\d{{4}})$', {k}) as int)")
    seen = df.where(F.col(column).isNotNull()).agg(
        F.count("*").alias("n"), F.count_if(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}")).alias("iso"), F.count_if(c.rlike(slash)).alias("slash"), F.max(part(1)).alias("first"), F.max(part(2)).alias("second"),
        F.count(F.try_to_date(c, "d/M/yyyy")).alias("as_day"), F.count(F.try_to_date(c, "M/d/yyyy")).alias("as_month"),
    ).first()
    n = max(seen["n"], 1)
    if seen["iso"] >= DATE_SHARE * n:
        return "iso"
    if seen["slash"] >= DATE_SHARE * n:
        if (seen["first"] or 0) > 12:
            return "day_first"
        if (seen["second"] or 0) > 12:
            return "month_first"
        if prefer_day_first:
            return "day_first"
    return "unknown" if not (seen["as_day"] or seen["as_month"]) else "day_first" if seen["as_day"] > seen["as_month"] else "month_first"


def parse_dates(df: DataFrame, column: str, prefer_day_first: bool = True) -> DataFrame:
    """df with column as a date, by the layout that the whole column follows; what doesn't parse is null."""
    layout = date_layout(df, column, prefer_day_first)
    c = F.trim(F.col(column).cast("string"))
    made = {"date": F.col(column).cast("date"), "iso": F.try_to_date(F.substring_index(F.substring_index(c, "T", 1), " ", 1), "yyyy-M-d"), "day_first": F.try_to_date(c, "d/M/yyyy"), "month_first": F.try_to_date(c, "M/d/yyyy"), "unknown": lit(None).cast("date")}[layout]
    return df.withColumn(column, made)


@dataclass
class SourceSchema:
    """Which column plays which role; DERIVED for what follows from the others."""

    kind: str
    roles: dict[str, str]
    unmapped: list[str] = field(default_factory=list)

    def raw(self, df: DataFrame) -> DataFrame:
        """The canonical columns as read, dates parsed, with _unread where one is given that can't be read."""
        given = F.col("_date").isNotNull() & (F.trim(F.col("_date").cast("string")) != "")
        names = {"property": "property", "date": "stay_date", "demand": "room_nights", "capacity": "capacity", "pickup": "pickup_rn", "lead": "lead_days", "snapshot": "snapshot_date"}
        rows = parse_dates(df.withColumn("_date", F.col(self.roles["date"])), self.roles["date"])
        if self.roles.get("snapshot", DERIVED) != DERIVED:
            rows = parse_dates(rows, self.roles["snapshot"])
        kept = [F.col(c).alias(names[r]) for r, c in self.roles.items() if c != DERIVED]
        if self.kind == "pickup" and self.roles["lead"] == DERIVED:
            kept.append(F.datediff(F.col(self.roles["date"]), F.col(self.roles["snapshot"])).alias("lead_days"))
        return rows.select(*kept, (given & F.col(self.roles["date"]).isNull()).alias("_unread"))

    def issues(self, df: DataFrame) -> DataFrame:
        """The quality issues of the source as read."""
        from ..operators import quality

        raw = self.raw(df)
        marked, plain = F.col("_unread"), [c for c in raw.columns if c != "_unread"]
        rows = raw.select(*plain, F.when(marked, lit("x")).alias("_unread"))  # a null, so that a row that is empty else stays empty
        unread = F.col("_unread").isNotNull()
        if self.kind == "pickup":
            return quality.pickup_issues(rows, self.roles["snapshot"] != DERIVED, unread)
        return (quality.demand_issues if self.kind == "demand" else quality.capacity_issues)(rows, unread)

    def coerce(self, df: DataFrame) -> DataFrame:
        """The canonical columns of the source, typed; rows without a stay date are dropped."""
        rows = parse_dates(df, self.roles["date"])
        property_ = F.coalesce(F.col(self.roles["property"]).cast("string"), lit(NO_PROPERTY)).alias("property")
        stay = F.col(self.roles["date"]).alias("stay_date")
        number = lambda role: F.nanvl(F.expr(f"try_cast(`{self.roles[role]}` as double)"), lit(None).cast("double"))
        if self.kind != "pickup":
            name = "room_nights" if self.kind == "demand" else "capacity"
            return rows.select(property_, stay, number(self.kind).alias(name)).where("stay_date is not null")
        if self.roles["snapshot"] != DERIVED:
            rows = parse_dates(rows, self.roles["snapshot"])
        lead = F.datediff(F.col(self.roles["date"]), F.col(self.roles["snapshot"])) if self.roles["lead"] == DERIVED else number("lead").cast("int")
        snapshot = F.date_sub(F.col(self.roles["date"]), lead) if self.roles["snapshot"] == DERIVED else F.col(self.roles["snapshot"])
        return rows.select(property_, stay, snapshot.alias("snapshot_date"), lead.alias("lead_days"), number("pickup").alias("pickup_rn")).where("stay_date is not null")


def normal_name(name: str) -> str:
    return name.strip().lower().replace("-", "_").replace(" ", "_")


def detect_schema(df: DataFrame, kind: str) -> SourceSchema:
    """Roles by name, else by content: a date is a column of which 9 of 10 sampled values parse; a property the
    first text column with few different values; a metric the first numeric one left. One sample, one aggregation."""
    used: dict[str, str] = {}
    names = {normal_name(c): c for c in reversed(df.columns)}

    def by_name(role: str) -> str | None:
        return next((names[h] for h in HINTS[role] if h in names and names[h] not in used.values()), None)

    sample = df.limit(SAMPLE).collect()

    def date_like(c: str) -> bool:
        if isinstance(df.schema[c].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return True
        import re

        seen = [str(r[c]) for r in sample if r[c] is not None]
        return isinstance(df.schema[c].dataType, T.StringType) and bool(seen) and sum(bool(re.match(r"\d{4}-\d{1,2}-\d{1,2}|\d{1,2}/\d{1,2}/\d{4}", s)) for s in seen) >= DATE_SHARE * len(seen)

    def numeric(c: str) -> bool:
        if isinstance(df.schema[c].dataType, T.NumericType):
            return True
        seen = [r[c] for r in sample if r[c] is not None]
        try:
            return isinstance(df.schema[c].dataType, T.StringType) and bool(seen) and all(float(s) is not None for s in seen)
        except ValueError:
            return False

    used["date"] = by_name("date") or next((c for c in df.columns if c not in used.values() and date_like(c)), "")
    used["property"] = by_name("property") or ""
    if not used["property"]:
        texts = [c for c in df.columns if c not in used.values() and isinstance(df.schema[c].dataType, T.StringType) and not date_like(c) and not numeric(c)]
        if texts:
            counts = df.agg(F.count("*").alias("_n"), *[F.approx_count_distinct(c).alias(c) for c in texts]).first()
            used["property"] = next((c for c in texts if 0 < counts[c] <= max(50, counts["_n"] / 10)), "")
    if kind == "pickup":
        used["lead"] = by_name("lead") or DERIVED
        used["snapshot"] = by_name("snapshot") or next((c for c in df.columns if c not in used.values() and date_like(c)), DERIVED)
    used[kind] = by_name(kind) or next((c for c in df.columns if c not in used.values() and numeric(c)), "")
    missing = [r for r, c in used.items() if not c]
    if kind == "pickup" and used["lead"] == used["snapshot"] == DERIVED:
        missing.append("lead or snapshot")
    if missing:
        raise SchemaDetectionError(f"{kind}: no column for {', '.join(missing)} among {', '.join(df.columns)}")
    return SourceSchema(kind, used, [c for c in df.columns if c not in used.values()])


def load_source(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, SourceSchema]:
    df = read_any(spark, path)
    schema = detect_schema(df, kind)
    return schema.coerce(df), schema


@dataclass
class Ingested:
    """The canonical sources of a run, and the issues found in them as read."""

    demand: DataFrame
    pickup: DataFrame
    capacity: DataFrame
    issues: DataFrame
    schemas: dict[str, SourceSchema]


def ingest(spark: SparkSession, paths: dict[str, str], aliases: dict[str, str] | None = None, closed: list[str] | None = None, gate: bool = True) -> Ingested:
    """Read demand, pickup and capacity; detect their schemas; check them as read; raise if the gate is on and an
    error was found; then type them, rename properties and leave out closed ones."""
    from functools import reduce

    from ..operators import quality

    frames = {k: read_any(spark, paths[k]) for k in ("demand", "pickup", "capacity")}
    schemas = {k: detect_schema(df, k) for k, df in frames.items()}
    issues = reduce(DataFrame.unionByName, [schemas[k].issues(frames[k]) for k in frames])
    if gate:
        quality.gate(issues)
    made = {k: exclude_properties(apply_aliases(schemas[k].coerce(df), aliases or {}), closed or []) for k, df in frames.items()}
    return Ingested(**made, issues=issues, schemas=schemas)


def apply_aliases(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """property with names replaced; null becomes the sentinel. A configuration's map: a literal in the plan."""
    name = F.coalesce(F.col("property").cast("string"), lit(NO_PROPERTY))
    if not aliases:
        return df.withColumn("property", name)
    return df.withColumn("property", F.coalesce(F.try_element_at(F.create_map(*[lit(x) for x in chain.from_iterable(aliases.items())]), name), name))


def exclude_properties(df: DataFrame, closed: list[str]) -> DataFrame:
    return df.where(~F.col("property").isin(*closed)) if closed else df


def load_events(spark: SparkSession, path: str | None) -> DataFrame | None:
    """event_name, event_date, property; None for a missing or empty file. A bad date or a repeated event raises."""
    from .store import exists

    if not path or not exists(spark, path):
        return None
    df = read_any(spark, path)
    names = {normal_name(c): c for c in df.columns}
    pick = lambda *hints: next((names[h] for h in hints if h in names), None)
    name, date, prop = pick("event_name", "name", "evento", "event"), pick("event_date", "date", "fecha"), pick("property", "propiedad", "hotel")
    if not name or not date:
        raise SchemaDetectionError("events need a name and a date")
    rows = parse_dates(df, date).select(F.col(name).alias("event_name"), F.col(date).alias("event_date"), (F.nullif(F.trim(F.col(prop)), lit("")) if prop else lit(None).cast("string")).alias("property"))
    if rows.isEmpty():
        return None
    if rows.where("event_date is null").count():
        raise ValueError("events with an unreadable date")
    if not rows.groupBy(*rows.columns).count().where("count > 1").isEmpty():
        raise ValueError("events are listed twice")
    return rows


def merge_checked(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join that raises if right's keys aren't unique, as it would multiply rows."""
    if not right.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"{keys} aren't unique on the right side")
    return left.join(right, keys, "left")


def sanitize(value):
    """JSON-safe: no NaN or infinity, keys as text."""
    if isinstance(value, dict):
        return {("|".join(map(str, k)) if isinstance(k, tuple) else str(k)): sanitize(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [sanitize(v) for v in value]
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value if isinstance(value, (str, int, float, bool, type(None))) else str(value)


def latest_record(records: list[dict], mode: str | None = None) -> dict | None:
    return next((r for r in reversed(records) if mode is None or r.get("mode") == mode), None)
