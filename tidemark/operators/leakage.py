"""Leakage checks: does a feature know what it couldn't have known?"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import lit

from .asof import range_frame

STATS = ("mean", "std", "median", "min", "max", "sum")


class LeakageError(ValueError):
    """A frame or a split lets the future in."""


def close(a: Column, b: Column) -> Column:
    """Equal up to 1e-8 + 1e-5 * |b|; two nulls are equal."""
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(F.abs(a - b) <= 1e-8 + 1e-5 * F.abs(b))


def statistic(stat: str, value: str) -> Column:
    return {"mean": F.avg, "std": F.stddev_samp, "median": lambda c: F.percentile(c, 0.5), "min": F.min, "max": F.max, "sum": F.sum}[stat](value)


def split_problems(config: dict) -> list[str]:
    """What in a split's configuration isn't temporal."""
    found = [f"{k}={v}" for k, v in config.items() if isinstance(v, str) and re.search(r"random|shuffle|kfold(?!.*time)", v, re.I)]
    if config.get("shuffle"):
        found.append("shuffle")
    if config.get("random_state") is not None and config.get("strategy") not in ("temporal", "expanding", "rolling"):
        found.append("random_state without a temporal strategy")
    if config.get("val_start") is not None and config.get("train_end") is not None and config["val_start"] < config["train_end"]:
        found.append("validation starts before training ends")
    return found


def temporal_order(train: DataFrame, validation: DataFrame, date: str = "stay_date") -> DataFrame:
    """train_end, val_start, ordered: one row."""
    return train.agg(F.max(date).alias("train_end")).crossJoin(validation.agg(F.min(date).alias("val_start"))).withColumn("ordered", F.col("val_start") > F.col("train_end"))


def whole_data_feature(full: DataFrame, cutoff: str, feature_fn, feature: str, keys: list[str], date: str = "stay_date") -> DataFrame:
    """rows, like_full, like_honest, leaks: the stored feature of df against feature_fn on all rows and on those up
    to the cutoff. It leaks if it agrees with the first everywhere and not with the second."""
    at = F.col(date) <= lit(cutoff).cast("date")
    honest = feature_fn(full.where(at)).select(*keys, F.col(feature).alias("_honest"))
    whole = feature_fn(full).where(at).select(*keys, F.col(feature).alias("_full"))
    both = full.where(at).select(*keys, F.col(feature).alias("_stored") if feature in full.columns else lit(None).cast("double").alias("_stored")).join(honest, keys).join(whole, keys)
    like_full, like_honest = close(F.col("_stored"), F.col("_full")), close(F.col("_stored"), F.col("_honest"))
    return both.agg(F.count("*").alias("rows"), F.count_if(like_full).alias("like_full"), F.count_if(like_honest).alias("like_honest")).withColumn("leaks", (F.col("rows") > 0) & (F.col("like_full") == F.col("rows")) & (F.col("like_honest") < F.col("rows")))


def centred(df: DataFrame, feature: str, width: int, stat: str = "mean", value: str = "room_nights", cutoff: str | None = None) -> DataFrame:
    """feature, compared, differs_from_backward, includes_future: whether a stored rolling value is that of a
    window centred on its day, on calendar days, rather than of one that ends there."""
    rows = df if cutoff is None else df.where(F.col("stay_date") <= lit(cutoff).cast("date"))
    low, high = -(width // 2), (width - 1) // 2
    both = rows.withColumns({"_c": statistic(stat, value).over(range_frame("property", "stay_date", low, high)), "_b": statistic(stat, value).over(range_frame("property", "stay_date", -width + 1, 0))}).where(F.col(feature).isNotNull())
    same_c, same_b = close(F.col(feature), F.col("_c")), close(F.col(feature), F.col("_b"))
    g = both.agg(F.count("*").alias("compared"), F.count_if(~same_b).alias("differs_from_backward"), F.count_if(same_c).alias("_same"))
    return g.select(lit(feature).alias("feature"), "compared", "differs_from_backward", ((F.col("_same") == F.col("compared")) & (F.col("differs_from_backward") > 0)).alias("includes_future"))


def own_target(df: DataFrame, feature: str, stat: str, width: int, value: str = "room_nights") -> DataFrame:
    """feature, compared, includes_target: whether the stored values are those of the window that holds the day itself."""
    both = df.withColumns({"_own": statistic(stat, value).over(range_frame("property", "stay_date", -width + 1, 0)), "_past": statistic(stat, value).over(range_frame("property", "stay_date", -width, -1))}).where(F.col(feature).isNotNull())
    g = both.agg(F.count("*").alias("compared"), F.count_if(close(F.col(feature), F.col("_own"))).alias("_o"), F.count_if(~close(F.col(feature), F.col("_past"))).alias("_p"))
    return g.select(lit(feature).alias("feature"), "compared", ((F.col("_o") == F.col("compared")) & (F.col("_p") > 0)).alias("includes_target"))


def scan_rolling(df: DataFrame) -> DataFrame:
    """own_target of every column named rolling_<stat>_<width>."""
    from functools import reduce

    found = [(c, m[1], int(m[2])) for c in df.columns if (m := re.fullmatch(rf"rolling_({'|'.join(STATS)})_(\d+)", c))]
    if not found:
        return df.sparkSession.createDataFrame([], "feature string, compared long, includes_target boolean")
    return reduce(DataFrame.unionByName, [own_target(df, c, stat, w) for c, stat, w in found])


def no_future_reads(snapshots: DataFrame) -> Column:
    """Count of snapshots (columns cutoff, last_history) that read beyond their cutoff."""
    return F.count_if(F.col("last_history") > F.col("cutoff")).alias("future_reads")


def findings(
    features: DataFrame, cutoff: str, split: dict, dates: tuple[str, ...] = ("stay_date",), train: DataFrame | None = None, validation: DataFrame | None = None, whole: dict | None = None, windows: tuple[tuple[str, int, str], ...] = ()
) -> list[str]:
    """All that the checks find, in words; none for a clean run. train and validation: their days must follow one another.
    whole: feature -> (full frame, function that makes it, keys), for features that may have been made from later rows too. windows:
    (feature, width, statistic) of stored rolling values that may be centred on their day."""
    found = split_problems(split)
    for c in dates:
        late = features.where(F.col(c) > lit(cutoff).cast("date")).count()
        found += [f"{late} rows with {c} after {cutoff}"] if late else []
    if train is not None and validation is not None and temporal_order(train, validation).first()["ordered"] is False:
        found.append("validation days aren't after training days")
    for feature, (full, make, keys) in (whole or {}).items():
        if whole_data_feature(full, cutoff, make, feature, keys).first()["leaks"]:
            found.append(f"{feature} knows rows after {cutoff}")
    for feature, width, stat in windows:
        if centred(features, feature, width, stat).first()["includes_future"]:
            found.append(f"{feature} is centred on its day")
    return found + [f"{r['feature']} holds its own target" for r in scan_rolling(features).where("includes_target").collect()]


def suite(features: DataFrame, cutoff: str, split: dict, **more) -> None:
    """Raise LeakageError listing all that `findings` finds."""
    found = findings(features, cutoff, split, **more)
    if found:
        raise LeakageError("; ".join(found))
