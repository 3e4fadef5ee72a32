"""Shared vocabulary: how a series is keyed, and the fixed domain values."""

from __future__ import annotations

from dataclasses import dataclass

# The canonical sensor columns.
SENSOR_COLUMNS = (
    "air_temperature",
    "air_humidity",
    "air_pressure",
    "dew_point",
    "precipitation",
    "earth_humidity",
    "earth_temperature",
    "battery_voltage",
    "solar_panel_voltage",
)

# Inclusive physical limits per sensor; outside them a reading is void.
PHYSICAL_LIMITS = {
    "air_temperature": (-40.0, 70.0),
    "earth_temperature": (-40.0, 70.0),
    "air_humidity": (0.0, 100.0),
    "earth_humidity": (0.0, 100.0),
    "dew_point": (-50.0, 60.0),
    "air_pressure": (700.0, 1150.0),
    "precipitation": (0.0, 500.0),
    "battery_voltage": (0.0, 30.0),
    "solar_panel_voltage": (0.0, 50.0),
}

# Codes that loggers write in place of a missing reading.
SENTINELS = (-999.0, 999.0, -99.0, 9999.0, -9999.0)

# Moisture thresholds of the advisory rules, in percent.
MOISTURE_THRESHOLDS = {
    "critical_dry": 20.0,
    "irrigation_needed": 35.0,
    "adequate_max": 65.0,
    "saturated": 85.0,
}

TARGET = "earth_humidity"


@dataclass(frozen=True)
class SeriesSpec:
    """How rows form ordered series, and how long series are cut for parallel work.

    ``chunk_rows`` is the number of consecutive rows one window partition holds, and
    ``block_rows`` that of one packed block of a decomposition, where a series of a single
    block needs no exchange with others. ``bucket_seconds`` are the calendar levels (coarse to fine) used to
    number rows without ever sorting a whole series in one task: with days and seconds, a
    task sees the days of one series, the seconds of one of its days or the rows of one of
    its seconds, of which distinct microseconds allow a million.
    """

    series: tuple[str, ...] = ("series_id",)
    time: str = "timestamp"
    index: str = "row_idx"
    chunk_rows: int = 4096
    block_rows: int = 65_536
    bucket_seconds: tuple[int, ...] = (86_400, 1)

    @property
    def keys(self) -> list[str]:
        return list(self.series)
