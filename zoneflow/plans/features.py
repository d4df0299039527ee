"""Feature models: demand lags, prices, weather, and the wide table that joins them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.clock import hour_ending, plus_hours
from zoneflow.operators.series import series_window
from zoneflow.schemas import HORIZONS, PRICE_COLS, WEATHER_COLS

LAGS_H = (72, 168)
ROLLS_H = {"demand_roll_6h": (78, 72), "demand_roll_24h": (96, 72)}
PRICE_LAG_H = 48


def modelled_load(stg_load: DataFrame, zones: list[str]) -> DataFrame:
    """Zonal rows of the metered source: the only load the features are built from."""
    kept = stg_load.filter((F.col("source") == "pjm") & F.col("zone").isin(zones))
    return kept.select("time", "zone", "demand_mw")


def load_features(
    stg_load: DataFrame,
    zones: list[str],
    read_since: Column | None = None,
    write_since: Column | None = None,
    lag_mode: str = "row",
    index: DataFrame | None = None,
) -> DataFrame:
    """Demand with its 72 h and 168 h lags and two trailing means.

    A lag counts rows, so on a series with gaps it can reach further back than its name
    says. `lag_mode="time"` takes the value exactly that many hours back instead, and NULL
    where that hour is missing. `read_since` bounds the history read, `write_since` the rows
    returned; the difference is the history their lags need.
    """
    base = modelled_load(stg_load, zones)
    if read_since is not None:
        base = base.filter(F.col("time") >= read_since)
    rows_back = max(LAGS_H) if lag_mode == "row" else 0
    hours_back = max([h for h, _ in ROLLS_H.values()] + ([] if rows_back else [max(LAGS_H)]))

    def columns(w):
        if lag_mode == "row":
            lags = {f"demand_lag_{h}h": w.lag("demand_mw", h) for h in LAGS_H}
        else:
            lags = {f"demand_lag_{h}h": w.avg_between("demand_mw", h, h) for h in LAGS_H}
        return lags | {n: w.avg_between("demand_mw", *frame) for n, frame in ROLLS_H.items()}

    out = series_window(base, columns, rows_back=rows_back, hours_back=hours_back, index=index)
    return out if write_since is None else out.filter(F.col("time") >= write_since)


def lmp_features(stg_lmp: DataFrame, since: Column | None = None) -> DataFrame:
    kept = stg_lmp if since is None else stg_lmp.filter(F.col("time") >= since)
    return kept.groupBy("time", "zone").agg(*[F.avg(c).alias(c) for c in PRICE_COLS])


def weather_features(stg_weather: DataFrame, since: Column | None = None) -> DataFrame:
    """Means of all polls of an hour, under the hour's end."""
    kept = stg_weather if since is None else stg_weather.filter(F.col("time") >= since)
    return kept.groupBy(hour_ending("time").alias("time"), "zone").agg(
        *[F.avg(c).alias(c) for c in WEATHER_COLS], F.count("*").alias("observation_count")
    )


def features(
    load_feats: DataFrame, lmp_feats: DataFrame, weather_feats: DataFrame, since: Column | None = None
) -> DataFrame:
    """One wide row per zone-hour of load; prices 48 h behind it, weather of the same hour.

    The price side is shifted forward rather than the load side back: both joins then use
    the same key (time, zone) and the load side is shuffled once for the two of them.
    """
    kept = load_feats if since is None else load_feats.filter(F.col("time") >= since)
    prices = lmp_feats.select(
        plus_hours("time", PRICE_LAG_H).alias("time"),
        "zone",
        *[F.col(c).alias(f"{c}_lag_{PRICE_LAG_H}h") for c in PRICE_COLS],
    )
    weather = weather_feats.select("time", "zone", *WEATHER_COLS, "observation_count")
    return kept.join(prices, ["time", "zone"], "left").join(weather, ["time", "zone"], "left")


def build_labels(df: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Demand h rows ahead within the zone, never across zones."""
    return series_window(
        df,
        lambda w: {f"y_{h}h": w.lead("demand_mw", h) for h in HORIZONS},
        rows_ahead=max(HORIZONS),
        index=index,
    )
