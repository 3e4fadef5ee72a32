"""Column names: snake case, and synonyms mapped to the canonical vocabulary."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names that loggers use for each canonical column, in order of precedence.
SYNONYMS = {
    "air_temperature": (
        "air_temperature", "airtemperature", "air_temp", "temp_air", "air_temperature1",
        "air_temperature_1", "temperature", "temp",
    ),
    "air_humidity": (
        "air_humidity", "airhumidity", "air_humid", "humidity_air", "air_humidity1", "air_humidity_1",
    ),
    "air_pressure": ("air_pressure", "airpressure", "pressure", "barometric_pressure"),
    "dew_point": ("dew_point", "dewpoint", "dew_pt"),
    "precipitation": ("precipitation", "rainfall", "rain", "precip"),
    "earth_humidity": (
        "earth_humidity_1", "earth_humidity1", "earthhumidity1", "earth_humidity",
        "earthhumidity", "soil_moisture", "soil_humidity", "humidity", "moisture",
    ),
    "earth_temperature": (
        "earth_temperature_1", "earth_temperature1", "earthtemperature1",
        "earth_temperature", "earthtemperature", "soil_temperature",
    ),
    "battery_voltage": ("battery_voltage", "batteryvoltage", "batt_volt", "v_batt"),
    "solar_panel_voltage": (
        "solar_panel_voltage", "solarpanelvoltage", "solar_voltage", "solar_volt", "v_solar",
    ),
    "station_id": ("station_id", "stationid", "id", "device_id", "node_id"),
    "communicate_at": ("communicate_at", "communicateat", "datetime", "timestamp", "date_time"),
    "date": ("date", "record_date"),
    "time": ("time", "record_time"),
}

# Name parts that mark a table as environmental readings over time.
READING_PARTS = ("temp", "humid", "earth", "soil")
TIME_NAMES = ("date", "time", "communicate_at", "communicateat", "timestamp", "datetime")

# Shared by the name and the column versions of the rule.
CASE_CHANGE = r"([a-z0-9])([A-Z])"
SEPARATORS = r"[\s.-]+"


def snake_case(name: str) -> str:
    split = re.sub(CASE_CHANGE, r"\1_\2", str(name).strip())
    joined = re.sub(SEPARATORS, "_", split).lower()
    return re.sub("_+", "_", joined).strip("_")


def snake_case_column(text: Column) -> Column:
    """The same rule for names held as data."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    split = F.regexp_replace(trimmed, CASE_CHANGE, "$1_$2")
    joined = F.lower(F.regexp_replace(split, SEPARATORS, "_"))
    return F.regexp_replace(F.regexp_replace(joined, "_+", "_"), "^_|_$", "")


def canonical_name(name: str) -> str:
    plain = snake_case(name)
    return next((c for c, known in SYNONYMS.items() if plain in known), plain)


def canonical_places(names: list[str]) -> dict[str, list[int]]:
    """Of every canonical name: the positions of the names that mean it, the earlier synonym first."""
    groups: dict[str, list[int]] = {}
    for i, name in enumerate(names):
        groups.setdefault(canonical_name(name), []).append(i)

    def precedence(canonical: str, i: int) -> int:
        known = SYNONYMS.get(canonical, ())
        plain = snake_case(names[i])
        return known.index(plain) if plain in known else len(known)

    return {c: sorted(members, key=lambda i: precedence(c, i)) for c, members in groups.items()}


def first_of(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.coalesce(*columns)


def to_canonical(df: DataFrame) -> DataFrame:
    """Rename columns to the canonical vocabulary; unknown names stay, in snake case.

    Columns that share a canonical name are coalesced, the earlier synonym first.
    """
    # Positions instead of names: names with dots or differing only by case stay apart.
    flat = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    places = canonical_places(df.columns)
    return flat.select(*[first_of([F.col(f"_{i}") for i in at]).alias(c) for c, at in places.items()])


def looks_environmental(columns: list[str]) -> bool:
    """At least three columns, one of them a time and one a temperature, humidity or soil name."""
    names = [snake_case(c) for c in columns]
    reading = any(part in c for c in names for part in READING_PARTS)
    timed = any(c in TIME_NAMES or "time" in c for c in names)
    return len(names) >= 3 and reading and timed


def is_environmental(df: DataFrame) -> bool:
    """The name test, and at least one row."""
    return looks_environmental(df.columns) and not df.isEmpty()
