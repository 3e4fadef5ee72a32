"""Typing, deduplication, void readings and bounded imputation of station tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from fieldsignal.operators.index import drop_nearest, nearest_known, with_row_index
from fieldsignal.session import materialize
from fieldsignal.spec import PHYSICAL_LIMITS, SENSOR_COLUMNS, SENTINELS, TARGET, SeriesSpec


def parse_timestamp(text: Column, formats: Sequence[str] = ()) -> Column:
    """Text to TIMESTAMP_NTZ; what cannot be read becomes NULL."""
    tries = [text.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text.cast("string"), F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def unify_timestamp(df: DataFrame, formats: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Add ``timestamp`` from ``communicate_at``, else date + time, else a single column.

    Stacked tables may each carry another of these. By default every row takes the first
    case it has a value for; ``strict`` takes one case for the whole table.
    """
    names = set(df.columns)
    cases = []
    if "communicate_at" in names:
        cases.append(parse_timestamp(F.col("communicate_at"), formats))
    if {"date", "time"} <= names:
        day = F.split_part(F.trim(F.col("date").cast("string")), F.lit(" "), F.lit(1))
        clock = F.trim(F.col("time").cast("string"))
        # NULL if either part is missing, as concat does, so that the next case can apply.
        cases.append(parse_timestamp(F.concat(day, F.lit(" "), clock), formats))
    cases += [parse_timestamp(F.col(c), formats) for c in ("timestamp", "datetime", "date") if c in names]
    if not cases:
        raise ValueError("no communicate_at, date, time or timestamp column to build a timestamp from")
    return df.withColumn("timestamp", cases[0] if strict else F.coalesce(*cases))


def to_reading(value: Column) -> Column:
    """Number or NULL: unreadable text and NaN are missing readings."""
    text = value.cast("string")
    typed_literal = F.coalesce(text.rlike(r"[0-9.][dDfF]\s*$"), F.lit(False))
    number = F.when(~typed_literal, value.try_cast("double"))
    return F.when(~F.isnan(number), number)


def coerce_sensors(df: DataFrame, columns: Sequence[str] = SENSOR_COLUMNS) -> DataFrame:
    return df.withColumns({c: to_reading(F.col(c)) for c in columns if c in df.columns})


def standardize(df: DataFrame, formats: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Timestamp, rows without one dropped, sensors as DOUBLE."""
    return coerce_sensors(unify_timestamp(df, formats, strict).na.drop(subset=["timestamp"]))


def deduplicate(df: DataFrame, spec: SeriesSpec, ingest_order: str | None = None) -> DataFrame:
    """One row per (series, time): numbers averaged, the rest first non-NULL.

    Also merges the rows that different sheets hold for one time. ``ingest_order`` names
    the column that defines "first"; without it the smallest value is taken, so that the
    result never depends on how rows are spread.
    """
    keys = [*spec.keys, spec.time]
    aggregates = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if field.name in keys or field.name == ingest_order:
            continue
        if isinstance(field.dataType, NumericType):
            aggregates.append(F.avg(c).alias(field.name))
        elif ingest_order:
            aggregates.append(F.min_by(c, F.when(c.isNotNull(), F.col(ingest_order))).alias(field.name))
        else:
            aggregates.append(F.min(c).alias(field.name))
    return df.groupBy(*keys).agg(*aggregates)


def _present(df: DataFrame, limits: dict[str, tuple[float, float]]) -> dict[str, tuple[float, float]]:
    return {c: bounds for c, bounds in limits.items() if c in df.columns}


def _is_sentinel(c: str) -> Column:
    return F.col(c).isin(*SENTINELS)


def _is_outside(c: str, bounds: tuple[float, float]) -> Column:
    return (F.col(c) < bounds[0]) | (F.col(c) > bounds[1])


def null_sentinels(df: DataFrame, limits: dict[str, tuple[float, float]] = PHYSICAL_LIMITS) -> DataFrame:
    return df.withColumns({c: F.when(~_is_sentinel(c), F.col(c)) for c in _present(df, limits)})


def null_out_of_bounds(df: DataFrame, limits: dict[str, tuple[float, float]] = PHYSICAL_LIMITS) -> DataFrame:
    return df.withColumns(
        {c: F.when(~_is_outside(c, b), F.col(c)) for c, b in _present(df, limits).items()}
    )


def sanitize(df: DataFrame, limits: dict[str, tuple[float, float]] = PHYSICAL_LIMITS) -> DataFrame:
    """Sentinel codes and physically impossible readings become NULL."""
    return df.withColumns(
        {c: F.when(~(_is_sentinel(c) | _is_outside(c, b)), F.col(c)) for c, b in _present(df, limits).items()}
    )


def sanitize_report(
    df: DataFrame, spec: SeriesSpec, limits: dict[str, tuple[float, float]] = PHYSICAL_LIMITS
) -> DataFrame:
    """Per series and column: how many cells ``sanitize`` would void."""
    present = _present(df, limits)
    counted = df.groupBy(*spec.keys).agg(
        *[F.count_if(_is_sentinel(c) | _is_outside(c, b)).alias(c) for c, b in present.items()]
    )
    return counted.unpivot(spec.keys, list(present), "column_name", "voided")


def _line(c: str, at: Column) -> Column:
    """Value at position ``at`` on the line between the readings around a gap."""
    slope = (F.col(f"_nv_{c}") - F.col(f"_pv_{c}")) / (F.col(f"_ni_{c}") - F.col(f"_pi_{c}"))
    return F.col(f"_pv_{c}") + slope * (at - F.col(f"_pi_{c}"))


def _interpolated(c: str, spec: SeriesSpec, limit: int) -> Column:
    i, before, after = F.col(spec.index), F.col(f"_pi_{c}"), F.col(f"_ni_{c}")
    reached = (i - before <= limit) | (after - i <= limit)
    return (
        F.when(F.col(c).isNotNull(), F.col(c))
        .when(before.isNotNull() & after.isNotNull() & reached, _line(c, i))
        .when(after.isNull() & (i - before <= limit), F.col(f"_pv_{c}"))
        .when(before.isNull() & (after - i <= limit), F.col(f"_nv_{c}"))
    )


def _filled(c: str, spec: SeriesSpec, limit: int) -> Column:
    """What back-fill, then forward-fill, put where interpolation did not reach."""
    before, after = F.col(f"_pi_{c}"), F.col(f"_ni_{c}")
    return (
        F.when(before.isNotNull() & after.isNotNull(), _line(c, after - limit))
        .when(after.isNotNull(), F.col(f"_nv_{c}"))
        .otherwise(F.col(f"_pv_{c}"))
    )


def interpolate(df: DataFrame, spec: SeriesSpec, columns: Sequence[str], limit: int = 12) -> DataFrame:
    """Linear by row position, at most ``limit`` rows in from each side of a gap; open
    gaps at the ends take the nearest reading for at most ``limit`` rows."""
    near = nearest_known(df, spec, columns)
    return drop_nearest(near.withColumns({c: _interpolated(c, spec, limit) for c in columns}), columns)


def zero_missing(df: DataFrame, column: str = "precipitation") -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(0.0)))


def fill_edges(df: DataFrame, spec: SeriesSpec, columns: Sequence[str]) -> DataFrame:
    """Back-fill, then forward-fill, over any distance."""
    near = nearest_known(df, spec, columns)
    return drop_nearest(
        near.withColumns({c: F.coalesce(F.col(c), F.col(f"_nv_{c}"), F.col(f"_pv_{c}")) for c in columns}),
        columns,
    )


def impute(df: DataFrame, spec: SeriesSpec, columns: Sequence[str], limit: int = 12) -> DataFrame:
    """``interpolate``, ``zero_missing`` for rain and ``fill_edges`` in a single pass:
    the nearest readings around a gap determine all three."""
    near = nearest_known(df, spec, columns)
    values = {}
    for c in columns:
        rest = F.lit(0.0) if c == "precipitation" else _filled(c, spec, limit)
        values[c] = F.coalesce(_interpolated(c, spec, limit), rest)
    return drop_nearest(near.withColumns(values), columns)


def require_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows whose target is known; an absent target column is an error."""
    if target not in df.columns:
        raise KeyError(f"target column {target!r} is not in the table")
    return df.na.drop(subset=[target])


def clean(
    df: DataFrame, spec: SeriesSpec, target: str = TARGET, ingest_order: str | None = None, limit: int = 12
) -> DataFrame:
    """Deduplicate, void impossible readings, impute, keep rows with a target; indexed.

    Averages are taken before sentinels are removed. A series can only lose rows at the
    end when its target is never known, and then it loses all of them, so the positions
    stay valid. The indexed table is written once, since imputation reads it twice.
    """
    if target not in df.columns:
        raise KeyError(f"target column {target!r} is not in the table")
    merged = sanitize(deduplicate(df, spec, ingest_order))
    sensors = [c for c in SENSOR_COLUMNS if c in merged.columns]
    indexed = materialize(with_row_index(merged, spec))
    return require_target(impute(indexed, spec, sensors, limit), target)


def preprocess_single(df: DataFrame, spec: SeriesSpec, **options) -> DataFrame:
    """One raw canonical table to a clean indexed table."""
    return clean(standardize(df), spec, **options)


def combine_and_clean(first: DataFrame, second: DataFrame, spec: SeriesSpec, **options) -> DataFrame:
    """Two raw canonical tables, stacked by name with NULL padding, then cleaned."""
    stacked = standardize(first).unionByName(standardize(second), allowMissingColumns=True)
    return clean(stacked, spec, **options)
