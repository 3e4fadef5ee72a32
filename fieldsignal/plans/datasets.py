"""Base relations the catalog's queries run on, derived from the given tables.

* ``readings``: every event as a reading; five long series, one per event type.
* ``station_sheets``: the same events as raw text sheets of many stations, the way
  loggers deliver them; a station is a block of users, so stations grow with the data.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldsignal.operators.clean import clean, standardize
from fieldsignal.operators.index import with_row_index
from fieldsignal.session import materialize
from fieldsignal.sources.tables import stack_tables, union_all
from fieldsignal.spec import SENSOR_COLUMNS, SeriesSpec

# Chunks and blocks are kept small here, so that seams between them occur at small scale too.
READINGS = SeriesSpec(chunk_rows=1024, block_rows=1024)
# Station times are whole minutes, so after deduplication a day holds at most 1,440 rows
# of a station and one calendar level is enough to number them. The raw sheets hold any
# number of rows per minute and are numbered with both levels.
STATIONS = SeriesSpec(series=("station_id",), chunk_rows=1024, bucket_seconds=(86_400,))
STATION_SHEETS = replace(STATIONS, bucket_seconds=SeriesSpec.bucket_seconds)
USERS_PER_STATION = 100

# Which event type plays which sensor, with the header a raw sheet gives it.
SOIL_SHEET = {"click": "earthHumidity1", "signup": "earthTemperature1"}
WEATHER_SHEET = {"view": "airTemperature", "purchase": "Air Humidity", "error": "rain"}
EARLY_UNTIL = "2024-01-16"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("earth_humidity"),
        "event_id",
    )


def indexed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_row_index(readings(spark, sf_dir), READINGS, tie_break=["event_id"])


def station_of(user: Column) -> Column:
    return F.concat(F.lit("st"), F.floor(user / USERS_PER_STATION).cast("string"))


def _sheet(events: DataFrame, sensors: dict[str, str]) -> DataFrame:
    value = F.col("value").cast("string")
    return events.where(F.col("event_type").isin(*sensors)).select(
        station_of(F.col("user_id")).alias("Station ID"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").cast("string").alias("communicateAt"),
        "event_id",
        *[F.when(F.col("event_type") == kind, value).alias(header) for kind, header in sensors.items()],
    )


def station_sheets(spark: SparkSession, sf_dir: str, early: bool) -> dict[str, DataFrame]:
    """The soil and the weather sheet of the early or the late dataset, all text."""
    events = table(spark, sf_dir, "events")
    border = F.lit(EARLY_UNTIL).cast("timestamp_ntz")
    part = events.where(F.col("ts") < border if early else F.col("ts") >= border)
    return {"soil": _sheet(part, SOIL_SHEET), "weather": _sheet(part, WEATHER_SHEET)}


def station_raw(spark: SparkSession, sf_dir: str, early: bool) -> DataFrame:
    return stack_tables(station_sheets(spark, sf_dir, early), "early" if early else "late")


def station_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both datasets, standardised and stacked: typed, with duplicate times."""
    parts = [standardize(station_raw(spark, sf_dir, early)) for early in (True, False)]
    return union_all(parts).drop("communicate_at")


def station_cleaned_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(station_stacked(spark, sf_dir), STATIONS, ingest_order="event_id")


def station_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table at the loggers' resolution of 0.01, written once: the operators
    after it read it several times."""
    cleaned = station_cleaned_exact(spark, sf_dir)
    sensors = [c for c in SENSOR_COLUMNS if c in cleaned.columns]
    return materialize(cleaned.withColumns({c: F.floor(F.col(c) * 100 + 0.5) / 100 for c in sensors}))
