"""Calendar, lag, rolling and signal features, and the lead target."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from fieldsignal.operators.index import over_chunks
from fieldsignal.spec import TARGET, SeriesSpec

# How far back each source column is looked up, and the feature names.
TARGET_LAGS = (1, 2, 3, 6, 12, 24)
OTHER_LAGS = {
    "earth_temperature": ("earth_temp", (1, 6, 12, 24)),
    "air_temperature": ("air_temperature", (1, 6, 24)),
    "air_humidity": ("air_humidity", (1, 6, 24)),
}
ROLLING_WINDOWS = (6, 12, 24)
RAIN_WINDOWS = (6, 24)
SIGNAL_LAGS = (1, 24)
EXTREMES_WINDOW = 24

# Columns that never become features.
EXCLUDED = (
    "station_id", "date", "time", "communicate_at", "source_sheet", "source_year",
    "timestamp", "anomaly_type", "overall_status", "status",
)

Columns = dict[str, Column]


def lead_target_name(horizon: int = 24) -> str:
    return f"target_{horizon}h_ahead"


def lead_target(w: WindowSpec, target: str = TARGET, horizon: int = 24) -> Columns:
    return {lead_target_name(horizon): F.lead(target, horizon).over(w)}


def hour_cycle(time: str) -> Columns:
    angle = 2 * math.pi * F.hour(time) / 24.0
    return {"hour_sin": F.sin(angle), "hour_cos": F.cos(angle)}


def month_cycle(time: str) -> Columns:
    angle = 2 * math.pi * (F.month(time) - 1) / 12.0
    return {"month_sin": F.sin(angle), "month_cos": F.cos(angle)}


def weekday_flags(time: str) -> Columns:
    day = F.weekday(time)
    return {"day_of_week": day, "is_weekend": (day >= 5).cast("int")}


def target_lags(w: WindowSpec, target: str = TARGET) -> Columns:
    return {f"earth_humidity_lag_{k}h": F.lag(target, k).over(w) for k in TARGET_LAGS}


def sensor_lags(w: WindowSpec, present: Sequence[str]) -> Columns:
    return {
        f"{prefix}_lag_{k}h": F.lag(c, k).over(w)
        for c, (prefix, lags) in OTHER_LAGS.items()
        if c in present
        for k in lags
    }


def with_rolling(
    df: DataFrame, w: WindowSpec, target: str = TARGET, parts: Sequence[str] = ("mean", "std", "extremes")
) -> DataFrame:
    """Trailing statistics including the current row, NULL until a frame is full.

    Each frame's number of readings and each aggregate is one window column, evaluated
    once; conditions and differences are added on top of them.
    """
    frames = {n: w.rowsBetween(-(n - 1), 0) for n in ROLLING_WINDOWS}
    made: dict[str, tuple[int, Column]] = {}
    if "mean" in parts:
        made |= {f"earth_humidity_roll_mean_{n}h": (n, F.avg(target)) for n in ROLLING_WINDOWS}
    if "std" in parts:
        made |= {f"earth_humidity_roll_std_{n}h": (n, F.stddev_samp(target)) for n in ROLLING_WINDOWS}
    if "extremes" in parts:
        made["earth_humidity_roll_min_24h"] = (EXTREMES_WINDOW, F.min(target))
        made["earth_humidity_roll_max_24h"] = (EXTREMES_WINDOW, F.max(target))
    needed = sorted({n for n, _ in made.values()})
    known = {f"_known_{n}": F.count(target).over(frames[n]) for n in needed}
    aggregates = {name: aggregate.over(frames[n]) for name, (n, aggregate) in made.items()}
    full = {name: F.when(F.col(f"_known_{n}") == n, F.col(name)) for name, (n, _) in made.items()}
    out = df.withColumns(known | aggregates).withColumns(full).drop(*known)
    if "extremes" in parts:
        spread = F.col("earth_humidity_roll_max_24h") - F.col("earth_humidity_roll_min_24h")
        out = out.withColumn("earth_humidity_daily_range", spread)
    return out


def rain_sums(w: WindowSpec, rain: str = "precipitation") -> Columns:
    return {f"precip_accum_{n}h": F.sum(rain).over(w.rowsBetween(-(n - 1), 0)) for n in RAIN_WINDOWS}


def signal_lags(w: WindowSpec, target: str = TARGET) -> Columns:
    signal = f"{target}_reconstructed"
    return {f"{signal}_lag_{k}h": F.lag(signal, k).over(w) for k in SIGNAL_LAGS}


def feature_names(df: DataFrame, spec: SeriesSpec, target: str = TARGET, horizon: int = 24) -> list[str]:
    """Numeric and boolean columns other than keys, labels, targets and filter by-products."""
    dropped = {
        *EXCLUDED, *spec.keys, spec.time, spec.index, lead_target_name(horizon),
        f"{target}_raw", f"{target}_is_outlier", f"{target}_hampel_cleaned",
    }
    return [
        f.name
        for f in df.schema.fields
        if f.name not in dropped and isinstance(f.dataType, (NumericType, BooleanType))
    ]


def build_features(
    df: DataFrame, spec: SeriesSpec, target: str = TARGET, horizon: int = 24
) -> tuple[DataFrame, list[str], str]:
    """All features, rows complete in every one of them, with the feature and target names.

    One sort per chunk serves every frame.
    """
    present = df.columns
    back = max(*TARGET_LAGS, *ROLLING_WINDOWS, *RAIN_WINDOWS, *SIGNAL_LAGS)

    def build(padded: DataFrame, w: WindowSpec) -> DataFrame:
        windowed = lead_target(w, target, horizon) | target_lags(w, target) | sensor_lags(w, present)
        if "precipitation" in present:
            windowed |= rain_sums(w)
        if f"{target}_reconstructed" in present:
            windowed |= signal_lags(w, target)
        return with_rolling(padded.withColumns(windowed), w, target)

    featured = over_chunks(df, spec, back, horizon, build).withColumns(
        hour_cycle(spec.time) | month_cycle(spec.time) | weekday_flags(spec.time)
    )
    names = feature_names(featured, spec, target, horizon)
    label = lead_target_name(horizon)
    return featured.na.drop(subset=[*names, label]), names, label
