"""Lags, rolling means, as-of features, linear trends and per-series forecasts.

The series functions take daily tables: one row per key and day. Daily sums are made map-side, and a
key then has at most one row per calendar day, which bounds every window below.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions.dates import date_parts
from tidemill.functions.numbers import round_half_up
from tidemill.operators.aggregates import weekly


def daily_series(sales: DataFrame, keys: Sequence[str], day: str = "sale_date") -> DataFrame:
    """One row per key and day: units, revenue, mean unit price (cents) and the lowest discount."""
    return sales.groupBy(*keys, day).agg(
        F.sum("units_sold").alias("units_sold"),
        F.sum("revenue").alias("revenue"),
        F.min("discount_pct").alias("discount_pct"),
    ).withColumn("unit_price", round_half_up(F.col("revenue").cast("double") / F.col("units_sold"), 2))


def series_window(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def rolling_mean(df: DataFrame, keys: Sequence[str], order: str, col: str, first: int, last: int, name: str) -> DataFrame:
    """Mean over the rows ``first``..``last`` around each row, shrinking at the ends."""
    return df.withColumn(name, F.avg(col).over(series_window(keys, order).rowsBetween(first, last)))


def lag_columns(window, col: str, lags: Sequence[int]) -> dict[str, Column]:
    return {f"lag_{n}": F.lag(col, n).over(window) for n in lags}


def trailing_columns(window, col: str, sizes: Sequence[int]) -> dict[str, Column]:
    """Mean of the n rows before the current one; null until there are n."""
    out = {}
    for n in sizes:
        frame = window.rowsBetween(-n, -1)
        out[f"roll_{n}"] = F.when(F.count(col).over(frame) == n, F.avg(col).over(frame))
    return out


def add_history(df: DataFrame, keys: Sequence[str], order: str, col: str,
                lags: Sequence[int] = (7, 14, 30), rolls: Sequence[int] = (7, 30)) -> DataFrame:
    """Lags and trailing means; all share one sort."""
    w = series_window(keys, order)
    made = {**lag_columns(w, col, lags), **trailing_columns(w, col, rolls)}
    return df.select("*", *[c.alias(n) for n, c in made.items()])


def demand_features(daily: DataFrame, weather: DataFrame) -> DataFrame:
    """Calendar, history and weather columns; rows whose history is incomplete are dropped."""
    with_dates = daily.select("*", *[c.alias(n) for n, c in date_parts(F.col("sale_date")).items()])
    hist = add_history(with_dates, ["store_id", "product_id"], "sale_date", "units_sold")
    hist = hist.dropna(subset=["lag_7", "lag_14", "lag_30", "roll_7", "roll_30"])
    return hist.join(weather, ["store_id", "year", "month"], "left")


def as_of_history(
    targets: DataFrame, daily: DataFrame, keys: Sequence[str], target_day: str, col: str,
    lags: Sequence[int] = (7, 14, 30), rolls: Sequence[int] = (7, 30),
) -> DataFrame:
    """History features as known just before a target day.

    A lag of n is the n-th last value, a roll of n the mean of the last n; where fewer exist, the mean
    of what exists, and 0 without any history. Targets find their place in the history through one
    running count; targets with the same place share one look-back of at most ``max(n)`` rows.
    """
    ids, deep = list(keys), max(*lags, *rolls)
    past = daily.select(*ids, F.col("sale_date").alias("__d"), F.lit(1).alias("__kind"), F.col(col).cast("double").alias("__x"))
    asked = targets.select(*ids, F.col(target_day).alias("__d")).distinct().select(
        "*", F.lit(0).alias("__kind"), F.lit(None).cast("double").alias("__x")
    )
    # on the same day the target comes before the sale, which it must not see
    w = Window.partitionBy(*ids).orderBy("__d", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    placed = past.unionByName(asked).select("*", F.count("__x").over(w).alias("__n"), F.sum("__x").over(w).alias("__s"))
    spots = placed.filter("__kind = 0").select(*ids, F.col("__d").alias(target_day), "__n", (F.col("__s") / F.col("__n")).alias("__mean"))
    look = (
        spots.select(*ids, "__n").distinct().filter("__n > 0")
        .withColumn("__back", F.explode(F.sequence(F.lit(1), F.least(F.lit(deep).cast("bigint"), F.col("__n")).cast("int"))))
        .withColumn("__at", F.col("__n") - F.col("__back") + 1)
    )
    values = placed.filter("__kind = 1").select(*ids, F.col("__n").alias("__at"), "__x")
    near = look.join(values, [*ids, "__at"])
    wanted = [
        F.max(F.when(F.col("__back") == k, F.col("__x"))).alias(f"lag_{k}") for k in lags
    ] + [
        F.when(F.max("__n") >= k, F.avg(F.when(F.col("__back") <= k, F.col("__x")))).alias(f"roll_{k}") for k in rolls
    ]
    found = near.groupBy(*ids, "__n").agg(*wanted)
    names = [f"lag_{k}" for k in lags] + [f"roll_{k}" for k in rolls]
    known = spots.join(found, [*ids, "__n"], "left").select(
        *ids, target_day, *[F.coalesce(F.col(c), F.col("__mean"), F.lit(0.0)).alias(c) for c in names]
    )
    return targets.join(known, [*ids, target_day], "left")


def future_days(entities: DataFrame, start: Column, days: int, name: str = "target_date") -> DataFrame:
    """Every entity on each of the coming days: a sequence per row, not a cross join."""
    return entities.withColumn(name, F.explode(F.sequence(start, F.date_add(start, days - 1))))


def with_weather_defaults(df: DataFrame, weather: DataFrame, keys: Sequence[str] = ("store_id", "year", "month"),
                          defaults: Mapping[str, float] = fv.WEATHER_DEFAULTS) -> DataFrame:
    return df.join(weather, list(keys), "left").fillna(dict(defaults))


def price_forecast(df: DataFrame, units: str, base_price: str, discount_pct: str) -> DataFrame:
    """Discounted price, revenue and a band of 15% that does not go below 0."""
    price = round_half_up(F.col(base_price) * (1 - F.col(discount_pct) / 100), 4)
    return df.select(
        "*",
        price.alias("forecast_price"),
        round_half_up(F.col(units) * price, 2).alias("predicted_revenue"),
        round_half_up(F.greatest(F.lit(0.0), F.col(units) * 0.85), 2).alias("confidence_lower"),
        round_half_up(F.col(units) * 1.15, 2).alias("confidence_upper"),
    )


# ---- linear trend ---------------------------------------------------------------------------

def daily_mean(df: DataFrame, day: Column, value: str) -> DataFrame:
    return df.groupBy(day.alias("day")).agg(F.avg(value).alias("mean_value"))


def with_day_index(daily: DataFrame, day: str = "day") -> DataFrame:
    """Running number of the days from 0. The input has one row per calendar day, whatever the volume
    behind it, so the single window task stays small."""
    return daily.withColumn("day_no", (F.row_number().over(Window.orderBy(day)) - 1).cast("bigint"))


def linear_trend(indexed: DataFrame, horizon: int = 7, alert_pct: float = fv.PRICE_ALERT_PCT) -> DataFrame:
    """Least-squares line over the day numbers, projected ``horizon`` days ahead, with the change
    against the last observed mean and an alert flag."""
    y, x = F.col("mean_value"), F.col("day_no")
    fit = indexed.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.max(x).alias("last_no"),
        F.max("day").alias("last_day"),
        F.max_by(y, x).alias("current"),
    )
    ahead = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    predicted = F.col("intercept") + F.col("slope") * (F.col("last_no") + F.col("step"))
    change = (predicted - F.col("current")) / F.col("current") * 100
    return ahead.select(
        F.date_format(F.date_add("last_day", F.col("step")), "yyyy-MM-dd").alias("forecast_day"),
        F.round(predicted, 4).alias("predicted"),
        F.round(change, 2).alias("change_pct"),
        alert_flag(change, alert_pct).alias("alert"),
    )


def alert_flag(change: Column, limit: float = fv.PRICE_ALERT_PCT) -> Column:
    return F.when(F.abs(change) >= limit, F.lit("SÍ")).otherwise(F.lit("NO"))


def trend_fit_metrics(indexed: DataFrame) -> DataFrame:
    """Mean absolute error and R² of the line on its own data."""
    y, x = F.col("mean_value"), F.col("day_no")
    slope, intercept, r2 = indexed.agg(F.regr_slope(y, x), F.regr_intercept(y, x), F.regr_r2(y, x)).first()
    return indexed.agg(
        F.avg(F.abs(y - (F.lit(intercept) + F.lit(slope) * x))).alias("mae"), F.lit(r2).alias("r2")
    )


# ---- ARMA forecasts, one small series per group ---------------------------------------------

def _needs_difference(y: np.ndarray) -> bool:
    """Dickey-Fuller regression with constant and one lagged difference, 5% point about -2.89."""
    dy = np.diff(y)
    if len(dy) < 8 or np.ptp(y) == 0:
        return False
    design = np.column_stack([np.ones(len(dy) - 1), y[1:-1], dy[:-1]])
    coef, *_ = np.linalg.lstsq(design, dy[1:], rcond=None)
    resid = dy[1:] - design @ coef
    dof = max(len(resid) - 3, 1)
    cov = resid @ resid / dof * np.linalg.pinv(design.T @ design)
    return bool(coef[1] / np.sqrt(max(cov[1, 1], 1e-12)) > -2.89)


def _arma_forecast(y: np.ndarray, p: int, q: int, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """Two-step least squares (long autoregression for the shocks, then p lags and q shocks)."""
    mean = y.mean()
    z = y - mean
    long = min(max(p, q) + 4, max(len(z) // 4, 1))
    if len(z) <= long + p + q + 2:
        return np.full(horizon, mean), np.full(horizon, z.std())
    lagged = np.column_stack([z[long - i - 1 : len(z) - i - 1] for i in range(long)])
    ar, *_ = np.linalg.lstsq(lagged, z[long:], rcond=None)
    shocks = np.concatenate([np.zeros(long), z[long:] - lagged @ ar])
    start = long + max(p, q)
    design = np.column_stack(
        [z[start - i - 1 : len(z) - i - 1] for i in range(p)]
        + [shocks[start - i - 1 : len(z) - i - 1] for i in range(q)]
    )
    # a little ridge keeps short or flat series solvable
    gram = design.T @ design + 1e-6 * np.eye(p + q) * max(np.trace(design.T @ design), 1.0)
    coef = np.linalg.solve(gram, design.T @ z[start:])
    sigma = float(np.std(z[start:] - design @ coef))
    zs, es, psi = list(z[-p:]), list(shocks[-q:]), [1.0]
    out = []
    for step in range(horizon):
        nxt = sum(coef[i] * zs[-1 - i] for i in range(p)) + sum(coef[p + i] * es[-1 - i] for i in range(q))
        bound = 10 * (np.abs(z).max() + 1)
        zs.append(float(np.clip(nxt, -bound, bound)))
        es.append(0.0)
        out.append(zs[-1] + mean)
        k = step + 1
        psi.append(sum(coef[i] * psi[k - 1 - i] for i in range(min(p, k))) + (coef[p + k - 1] if k <= q else 0.0))
    spread = sigma * np.sqrt(np.cumsum(np.square(np.clip(psi[:horizon], -1e3, 1e3))))
    return np.array(out), spread


def _forecast(y: np.ndarray, order: tuple[int, int], horizon: int) -> tuple[np.ndarray, np.ndarray]:
    p, q = order
    if not _needs_difference(y):
        return _arma_forecast(y, p, q, horizon)
    steps, spread = _arma_forecast(np.diff(y), p, q, horizon)
    return y[-1] + np.cumsum(steps), np.sqrt(np.cumsum(spread**2))


def forecast_series(
    daily: DataFrame, keys: Sequence[str], value: str = "units_sold", day: str = "sale_date",
    order: tuple[int, int] = (2, 2), horizon: int = 8,
) -> DataFrame:
    """Weekly forecast of every series at once, with a 95% interval and the error of a backtest on the
    last ``horizon`` weeks. A group holds one number per calendar week.

    No series is left out: one of fewer than ``horizon + 4`` weeks, on which no model can be fitted, has a
    single row with the week after its last, no forecast and the status ``too_short``; without as many weeks
    again there is no backtest error."""
    series = weekly(daily, keys, day, value, "y")
    names = list(keys)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("week_end")
        y = pdf["y"].to_numpy(float)
        head = {k: pdf[k].iloc[0] for k in names}
        last = pd.Timestamp(pdf["week_end"].iloc[-1])
        if len(y) < horizon + 4:
            nothing = {c: [None] for c in ("forecast", "lower", "upper", "backtest_mae")}
            return pd.DataFrame({**{k: [v] for k, v in head.items()}, "week_end": [(last + pd.Timedelta(days=7)).date()], **nothing, "status": ["too_short"]})
        mae = None
        if len(y) >= 2 * (horizon + 4):
            back, _ = _forecast(y[:-horizon], order, horizon)
            mae = float(np.mean(np.abs(np.maximum(back, 0) - y[-horizon:])))
        mid, spread = _forecast(y, order, horizon)
        return pd.DataFrame(
            {
                **{k: [v] * horizon for k, v in head.items()},
                "week_end": [(last + pd.Timedelta(days=7 * (i + 1))).date() for i in range(horizon)],
                "forecast": np.maximum(mid, 0),
                "lower": np.maximum(mid - 1.96 * spread, 0),
                "upper": mid + 1.96 * spread,
                "backtest_mae": mae,
                "status": "ok",
            }
        )

    key_types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in series.schema if f.name in names)
    schema = f"{key_types}, week_end date, forecast double, lower double, upper double, backtest_mae double, status string"
    return series.groupBy(*names).applyInPandas(one, schema)
