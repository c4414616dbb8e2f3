"""Forecast-error metrics as aggregate columns, for use under any grouping."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalars import col, ratio

NAMES = ("n_obs", "n_mape_excluded", "mape", "wmape", "mae", "rmse", "bias")


def error_metrics(actual: Column | str = "actual", forecast: Column | str = "forecast") -> list[Column]:
    """Over the pairs without a null or NaN: n_obs; n_mape_excluded (pairs of actual 0); mape = 100 *
    mean(|f - a| / a) over the others; wmape = sum|f - a| / sum|a|; mae; rmse; bias = sum(f - a) / sum|a|.
    Without a pair all but the counts are null."""
    a, f = F.nanvl(col(actual).cast("double"), F.lit(None)), F.nanvl(col(forecast).cast("double"), F.lit(None))
    pair = a.isNotNull() & f.isNotNull()
    error, size = F.when(pair, f - a), F.when(pair, F.abs(a))
    return [
        F.count_if(pair).alias("n_obs"),
        F.count_if(pair & (a == 0)).alias("n_mape_excluded"),
        (100 * F.avg(ratio(F.abs(error), F.when(pair, a)))).alias("mape"),
        ratio(F.sum(F.abs(error)), F.sum(size)).alias("wmape"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        ratio(F.sum(error), F.sum(size)).alias("bias"),
    ]
