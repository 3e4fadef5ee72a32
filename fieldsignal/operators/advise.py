"""Threshold rules that turn a moisture forecast into an irrigation advisory."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsignal.spec import MOISTURE_THRESHOLDS, SeriesSpec

# Fixed value: rain in mm from which a deficit is left to the weather.
RAIN_RELIEF_MM = 5.0

# Wording per rule (status, recommendation, urgency).
WORDING = {
    "critical": ("CRITICAL DEFICIT", "Immediate Irrigation Urgently Required", "High"),
    "rain": ("DEFICIT (RAIN EXPECTED)", "Hold Irrigation / Monitor Rain", "Low"),
    "deficit": ("MOISTURE DEFICIT", "Irrigation Recommended", "Medium"),
    "optimal": ("OPTIMAL MOISTURE", "No Irrigation Required", "None"),
    "excess": ("SATURATION / EXCESS", "Irrigation Prohibited (Risk of Waterlogging)", "None"),
}

# Rationale per rule; %.1f is the forecast or the rain, %s a threshold.
RATIONALE = {
    "critical": "Forecasted moisture (%.1f%%) is below critical wilting threshold (%s%%).",
    "rain": "Moisture is low (%.1f%%), but upcoming rainfall (%.1fmm) will replenish soil.",
    "deficit": "Forecasted moisture (%.1f%%) falls below optimal threshold (%s%%).",
    "optimal": "Forecasted moisture (%.1f%%) is within optimal agronomic field capacity (%s%% - %s%%).",
    "excess": "Forecasted moisture (%.1f%%) indicates near-saturated conditions (> %s%%).",
}

# Short labels and actions per status.
STATUS_LABELS = {
    "CRITICAL DEFICIT": "Critically Dry",
    "MOISTURE DEFICIT": "Moderate Deficit",
    "DEFICIT (RAIN EXPECTED)": "Deficit (Rain Expected)",
    "OPTIMAL MOISTURE": "Optimal",
    "SATURATION / EXCESS": "Saturated",
}
STATUS_ACTIONS = {
    "CRITICAL DEFICIT": "Immediate watering required - saves crops",
    "MOISTURE DEFICIT": "Scheduled watering recommended",
    "DEFICIT (RAIN EXPECTED)": "Hold irrigation and monitor rain",
    "OPTIMAL MOISTURE": "No irrigation needed - saves water",
    "SATURATION / EXCESS": "Do not water - prevents root damage",
}
DEFAULT_ACTION = "Review the generated advisory details"


def thresholds_as_columns(overrides: Mapping[str, float] | None = None) -> dict[str, Column]:
    return {k: F.lit(float(v)) for k, v in {**MOISTURE_THRESHOLDS, **(overrides or {})}.items()}


def join_thresholds(df: DataFrame, per_station: DataFrame, keys: list[str]) -> tuple[DataFrame, dict[str, Column]]:
    """Attach a threshold table with one row per station; absent values fall back to the
    defaults. Whether to broadcast the table is left to its measured size."""
    own = [c for c in MOISTURE_THRESHOLDS if c in per_station.columns]
    table = per_station.select(*keys, *[F.col(c).cast("double").alias(f"_th_{c}") for c in own])
    defaults = thresholds_as_columns()
    columns = {c: F.coalesce(F.col(f"_th_{c}"), d) if c in own else d for c, d in defaults.items()}
    return df.join(table, keys, "left"), columns


def which_rule(moisture: Column, rain: Column, thresholds: Mapping[str, Column]) -> Column:
    """Name of the first rule that applies; NULL moisture gets none."""
    low = moisture < thresholds["irrigation_needed"]
    return (
        F.when(moisture.isNull(), F.lit(None).cast("string"))
        .when(moisture < thresholds["critical_dry"], "critical")
        .when(low & (rain >= RAIN_RELIEF_MM), "rain")
        .when(low, "deficit")
        .when(moisture <= thresholds["adequate_max"], "optimal")
        .otherwise("excess")
    )


def _by_rule(rule: Column, choices: Mapping[str, Column]) -> Column:
    chain = F
    for name, value in choices.items():
        chain = chain.when(rule == name, value)
    return chain


def rationale(rule: Column, moisture: Column, rain: Column, thresholds: Mapping[str, Column]) -> Column:
    m, r = F.round(moisture, 1), F.round(rain, 1)
    th = {k: v.cast("string") for k, v in thresholds.items()}
    arguments = {
        "critical": (m, th["critical_dry"]),
        "rain": (m, r),
        "deficit": (m, th["irrigation_needed"]),
        "optimal": (m, th["irrigation_needed"], th["adequate_max"]),
        "excess": (m, th["adequate_max"]),
    }
    return _by_rule(rule, {name: F.format_string(RATIONALE[name], *args) for name, args in arguments.items()})


def irrigation_need(
    moisture: Column, rain: Column | None = None, thresholds: Mapping[str, Column] | None = None
) -> Column:
    """One struct per forecast: predicted_moisture, status, recommendation, urgency, rationale."""
    thresholds = thresholds or thresholds_as_columns()
    rain = F.lit(0.0) if rain is None else rain
    rule = which_rule(moisture, rain, thresholds)
    wording = [
        _by_rule(rule, {name: F.lit(parts[i]) for name, parts in WORDING.items()}) for i in range(3)
    ]
    return F.struct(
        F.round(moisture, 2).alias("predicted_moisture"),
        wording[0].alias("status"),
        wording[1].alias("recommendation"),
        wording[2].alias("urgency"),
        rationale(rule, moisture, rain, thresholds).alias("agronomic_rationale"),
    )


def advisories(
    df: DataFrame,
    spec: SeriesSpec,
    predicted: str = "prediction",
    rain: str = "precipitation",
    thresholds: Mapping[str, Column] | None = None,
    horizon_hours: int = 24,
) -> DataFrame:
    """One advisory per forecast row, for the time ``horizon_hours`` ahead of it.

    The current row's rain stands in for the forecast rain, 0 where the table has none.
    """
    fallen = F.coalesce(F.col(rain), F.lit(0.0)) if rain in df.columns else F.lit(0.0)
    return df.select(
        *spec.keys,
        F.col(spec.time).alias("current_timestamp"),
        (F.col(spec.time) + F.make_dt_interval(hours=F.lit(horizon_hours))).alias("forecast_target_time"),
        irrigation_need(F.col(predicted), fallen, thresholds).alias("_a"),
    ).select(*spec.keys, "current_timestamp", "forecast_target_time", "_a.*")


def latest(advised: DataFrame, spec: SeriesSpec, n: int = 10) -> DataFrame:
    """The ``n`` most recent advisories over all series."""
    return advised.orderBy(F.desc("current_timestamp"), *spec.keys).limit(n)


def _lookup(table: Mapping[str, str], key: Column) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def describe_status(df: DataFrame, status: str = "status") -> DataFrame:
    """Add a short label and an action; unknown statuses are title-cased."""
    c = F.col(status)
    return df.withColumns(
        {
            "status_label": F.coalesce(_lookup(STATUS_LABELS, c), F.initcap(c)),
            "status_action": F.coalesce(_lookup(STATUS_ACTIONS, c), F.lit(DEFAULT_ACTION)),
        }
    )
