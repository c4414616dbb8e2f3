"""Scalar rules of the forecasting domain as column expressions (JVM-side, null-safe)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.functions import lit

# Fixed values.
SEASONS = {"high": (12, 1, 2), "low": (6, 7, 8, 9)}  # the other months are shoulder
BANDS = (("1-2", 2), ("3-6", 6), ("7-13", 13), ("14-29", 29), ("30-59", 59), ("60-89", 89))
LAST_BAND = "90+"
MODELS = ("seasonal_naive", "pickup_curve", "ets", "sarimax", "lightgbm", "xgboost", "catboost")
DRIVERS = (
    ("current_bookings", ("current_booked_rn", "current_bookings", "booked")),
    ("pickup", ("pickup", "lead", "expected_pickup")),
    ("seasonality", ("day_of_week", "dow", "month", "season", "weekend", "quarter", "week_of_year", "is_weekend", "lag_", "same_dow", "same_month")),
    ("capacity", ("capacity", "occupancy", "inventory")),
    ("trend", ("trend", "time", "index", "year")),
)
HOLIDAY_KEYS = (
    (("santo", "easter"), "semana_santa"),
    (("navidad", "christmas", "ano nuevo", "new year"), "fin_de_ano"),
    (("thanksgiving",), "thanksgiving"),
    (("memorial",), "memorial_day"),
    (("labor day",), "labor_day_us"),
    (("independence day", "julio"), "independencia_us"),
    (("independencia",), "independencia_cr"),
    (("anexion",), "anexion"),
    (("madre", "mother"), "dia_de_la_madre"),
)
ACCENTED, PLAIN = "áàâäãåéèêëíìîïóòôöõúùûüñçý", "aaaaaaeeeeiiiiooooouuuuncy"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b; null where b is 0."""
    return F.try_divide(col(a), col(b))


def season(date: Column | str) -> Column:
    month = F.month(col(date))
    return F.when(month.isin(*SEASONS["high"]), "high").when(month.isin(*SEASONS["low"]), "low").when(month.isNotNull(), "shoulder")


def lead_band(lead: Column | str) -> Column:
    """Bands of the days ahead; 0 and below fall in the first, null in the last."""
    out = F.when(col(lead) <= BANDS[0][1], BANDS[0][0])
    for name, top in BANDS[1:]:
        out = out.when(col(lead) <= top, name)
    return out.otherwise(LAST_BAND)


def band_order(band: Column | str) -> Column:
    return F.array_position(F.array(*[lit(b) for b, _ in BANDS], lit(LAST_BAND)), col(band)).cast("int")


def accuracy_band(mape: Column | str) -> Column:
    m = col(mape)
    return F.when(m.isNull() | F.isnan(m), "no data").when(m < 10, "excellent").when(m < 20, "acceptable").when(m < 25, "reasonable if seasonal").otherwise("outside the references")


def bias_direction(bias: Column | str) -> Column:
    b = col(bias)
    return F.when(b.isNull() | F.isnan(b), "no data").when(b > 0.001, "over").when(b < -0.001, "under").otherwise("none")


def plain(text: Column | str) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(col(text)), ACCENTED, PLAIN)


def slug(text: Column | str) -> Column:
    return F.btrim(F.regexp_replace(plain(F.trim(col(text))), "[^a-z0-9]+", "_"), lit("_"))


def holiday_key(name: Column | str) -> Column:
    """The first rule with a token in the name; else the name's slug."""
    out, text = None, plain(name)
    for tokens, key in HOLIDAY_KEYS:
        hit = lit(False)
        for t in tokens:
            hit |= F.contains(text, lit(t))
        out = F.when(hit, key) if out is None else out.when(hit, key)
    return out.otherwise(slug(name))


def driver(feature: Column | str) -> Column:
    out, text = None, F.lower(col(feature))
    for name, tokens in DRIVERS:
        hit = lit(False)
        for t in tokens:
            hit |= F.contains(text, lit(t))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


def parsimony(model: Column | str) -> Column:
    """0 for the simplest model; len(MODELS) for an unknown one."""
    at = F.array_position(F.array(*[lit(m) for m in MODELS]), F.lower(col(model))).cast("int")
    return F.when(at > 0, at - 1).otherwise(len(MODELS))


def week_start(date: Column | str) -> Column:
    """Monday of the date's week."""
    return F.date_trunc("week", col(date)).cast("date")


def day_number(date: Column | str) -> Column:
    return F.unix_date(col(date))


def r6(c: Column | str) -> Column:
    """Rounded to six places, without a negative zero: how results are published and compared."""
    return F.round(col(c).cast("double"), 6) + lit(0.0)
