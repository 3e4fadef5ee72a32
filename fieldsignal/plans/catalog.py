"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldsignal.operators import (
    advise, attribute, clean, decompose, evaluate, features, hampel, index, model, profile, reconstruct, split,
)
from fieldsignal.plans import datasets as base
from fieldsignal.plans.datasets import READINGS, STATIONS
from fieldsignal.session import materialize, shared_folder
from fieldsignal.sources import naming, sinks, tables
from fieldsignal.spec import TARGET, SeriesSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ROW = [*READINGS.keys, READINGS.index]
STATION_ROW = [*STATIONS.keys, STATIONS.index]
STATION_SENSORS = ["earth_humidity", "earth_temperature", "air_temperature", "air_humidity", "precipitation"]
SPIKE_LIMITS = {TARGET: (0.0, 100.0)}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles rounded, so that engines that add in another order still agree."""
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


# --- sources -------------------------------------------------------------------------


@query
def s3_stack_sheets(spark, sf):
    """Soil and weather sheets canonicalised, tagged and stacked with NULL padding."""
    stacked = base.station_raw(spark, sf, True).unionByName(base.station_raw(spark, sf, False))
    return stacked.select(
        "station_id", "communicate_at", "event_id", *STATION_SENSORS, "source_sheet", "source_year"
    )


@query
def s5_snake_case(spark, sf):
    """The column-name rule applied to names held as data."""
    pages = base.table(spark, sf, "pages")
    return pages.select("page_id", naming.snake_case_column(F.col("url")).alias("plain_name"))


@query
def s6_canonical_columns(spark, sf):
    """Raw headers renamed by synonym; two headers of one meaning are coalesced."""
    events = base.table(spark, sf, "events")
    value = F.col("value")
    raw = events.select(
        F.col("event_id").alias("ID"),
        F.col("ts").alias("dateTime"),
        F.when(value > 50, value).alias("soil-moisture"),
        F.when(value < 80, value + 1).alias("earthHumidity1"),
        F.col("user_id").alias("V.Batt"),
    )
    return naming.to_canonical(raw)


@query
def s7_provenance(spark, sf):
    """Rows per source tag."""
    stacked = base.station_stacked(spark, sf)
    return stacked.groupBy("source_year", "source_sheet").agg(F.count(F.lit(1)).alias("n_rows"))


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


@query
def s2_csv_sheets(spark, sf):
    """The sheets written as CSV files, found by label and read back as text."""
    folder = _folder(spark)
    for early, label in ((True, "early"), (False, "late")):
        for name, sheet in base.station_sheets(spark, sf, early).items():
            sinks.write_csv(sheet, f"{folder}/data/raw/stations_{label}/{name}.csv")
    first, second = tables.load_pair(spark, folder, ("early", "late"))
    stacked = clean.standardize(first).unionByName(clean.standardize(second))
    return stacked.select(
        "station_id", "timestamp", F.col("event_id").cast("long").alias("event_id"), *STATION_SENSORS,
        "source_sheet", "source_year",
    )


@query
def s8_mirrored_channels(spark, sf):
    """A test table without soil channels takes them from the air channels."""
    path = f"{_folder(spark)}/abnormal_weather.parquet"
    base.station_sheets(spark, sf, True)["weather"].write.parquet(path)
    loaded = clean.standardize(tables.load_abnormal(spark, path))
    return loaded.select("event_id", *STATION_SENSORS, "source_sheet", "source_year")


@query
def s10_series_sink(spark, sf):
    """The clean table written by month and series, and read back."""
    path = _folder(spark)
    sinks.write_series(base.station_clean(spark, sf), path, STATIONS)
    stored = spark.read.parquet(path)
    return stored.select(*STATION_ROW, "timestamp", *STATION_SENSORS, F.col("month").cast("string").alias("month"))


@query
def s11_metrics_sink(spark, sf):
    """The metrics of all splits written as JSON and read back."""
    path = _folder(spark)
    metrics = e3_all_splits(spark, sf)
    sinks.write_metrics(metrics, path)
    return spark.read.schema(metrics.schema).json(path)


# --- typing, deduplication, imputation -----------------------------------------------


@query
def p1_unify_timestamp(spark, sf):
    """Three delivery forms of a timestamp, and unreadable text."""
    events = base.table(spark, sf, "events")
    second = F.date_trunc("second", "ts").cast("timestamp_ntz")
    text = F.when(F.col("value") > 200, "not a time").otherwise(second.cast("string"))
    kind = F.col("event_type")
    raw = events.select(
        "event_id",
        F.when(kind.isin("click", "view"), text).alias("communicate_at"),
        F.when(kind.isin("signup", "purchase"), F.concat(second.cast("date").cast("string"), F.lit(" 00:00:00"))).alias("date"),
        F.when(kind.isin("signup", "purchase"), F.concat(F.lit(" "), F.date_format(second, "HH:mm:ss"))).alias("time"),
        F.when(kind == "error", text).alias("datetime"),
    )
    return clean.unify_timestamp(raw).select("event_id", "timestamp")


@query
def p2_drop_untimed(spark, sf):
    raw = p1_unify_timestamp(spark, sf)
    return raw.na.drop(subset=["timestamp"])


@query
def p3_coerce_numbers(spark, sf):
    """Text, NaN and blanks to NULL; readable numbers to DOUBLE."""
    events = base.table(spark, sf, "events")
    v = F.col("value")
    text = (
        F.when(v > 150, "n/a").when(v > 100, "NaN").when(v < 1, "").when(v < 5, F.concat(F.lit(" "), v.cast("string")))
        .otherwise(v.cast("string"))
    )
    return clean.coerce_sensors(events.select("event_id", text.alias("air_temperature")))


@query
def p4_sorted_positions(spark, sf):
    """Chronological order, expressed as the rank a sort would give."""
    return base.indexed_readings(spark, sf).select("series_id", "row_idx", "timestamp", "event_id")


@query
def p5_duplicate_count(spark, sf):
    return profile.duplicate_count(base.station_stacked(spark, sf), STATIONS)


@query
def p6_deduplicate(spark, sf):
    merged = clean.deduplicate(base.station_stacked(spark, sf), STATIONS, ingest_order="event_id")
    return rounded(merged.select("station_id", "timestamp", *STATION_SENSORS, "source_sheet", "source_year"))


def _with_sentinels(spark, sf) -> DataFrame:
    """Readings in which some users' loggers write fault codes."""
    events = base.table(spark, sf, "events")
    v = F.col("value")
    faulty = F.when(v < 3, -999.0).when(v < 4, 999.0).when(v < 5, -99.0).when(v > 300, 9999.0).otherwise(v)
    return events.select(
        F.col("event_type").alias("series_id"),
        "event_id",
        faulty.alias("earth_humidity"),
        (faulty * 2 - 60).alias("air_temperature"),
        (faulty + 690).alias("air_pressure"),
    )


@query
def p7_null_sentinels(spark, sf):
    return clean.null_sentinels(_with_sentinels(spark, sf))


@query
def p8_null_out_of_bounds(spark, sf):
    return clean.null_out_of_bounds(_with_sentinels(spark, sf))


@query
def p8_void_counts(spark, sf):
    return clean.sanitize_report(_with_sentinels(spark, sf), READINGS)


@query
def p9_row_index(spark, sf):
    stacked = base.station_stacked(spark, sf)
    numbered = index.with_row_index(stacked, base.STATION_SHEETS, tie_break=["event_id"], length="n_rows")
    return numbered.select("station_id", "event_id", "row_idx", "n_rows")


def _gappy(spark, sf) -> DataFrame:
    """Indexed readings with impossible values voided."""
    return clean.sanitize(base.indexed_readings(spark, sf), SPIKE_LIMITS)


def _gappy_stations(spark, sf) -> DataFrame:
    merged = clean.deduplicate(base.station_stacked(spark, sf), STATIONS, ingest_order="event_id")
    return index.with_row_index(clean.sanitize(merged), STATIONS)


@query
def p10_interpolate(spark, sf):
    gappy = _gappy_stations(spark, sf).select(*STATION_ROW, *STATION_SENSORS)
    return rounded(clean.interpolate(gappy, STATIONS, STATION_SENSORS))


@query
def p11_zero_rain(spark, sf):
    gappy = _gappy_stations(spark, sf).select(*STATION_ROW, "precipitation")
    return rounded(clean.zero_missing(clean.interpolate(gappy, STATIONS, ["precipitation"])))


@query
def p12_fill_edges(spark, sf):
    gappy = _gappy_stations(spark, sf).select(*STATION_ROW, *STATION_SENSORS)
    return rounded(clean.fill_edges(gappy, STATIONS, STATION_SENSORS))


@query
def p13_require_target(spark, sf):
    return clean.require_target(_gappy(spark, sf)).select(*ROW, TARGET)


@query
def p14_clean(spark, sf):
    cleaned = base.station_cleaned_exact(spark, sf)
    return rounded(cleaned.select(*STATION_ROW, "timestamp", *STATION_SENSORS, "source_sheet", "source_year"))


@query
def p15_combine_and_clean(spark, sf):
    early, late = (base.station_raw(spark, sf, early) for early in (True, False))
    cleaned = clean.combine_and_clean(early, late, STATIONS, ingest_order="event_id")
    return rounded(cleaned.select(*STATION_ROW, "timestamp", *STATION_SENSORS, "source_sheet", "source_year"))


@query
def p15_preprocess_single(spark, sf):
    cleaned = clean.preprocess_single(base.station_raw(spark, sf, True), STATIONS, ingest_order="event_id")
    return rounded(cleaned.select(*STATION_ROW, "timestamp", *STATION_SENSORS, "source_sheet", "source_year"))


@query
def p16_keep_raw(spark, sf):
    flagged = hampel.hampel(base.indexed_readings(spark, sf), READINGS)
    return rounded(flagged.drop("event_id", "timestamp"))


@query
def p17_complete_rows(spark, sf):
    """Rows that survive when every lag and the lead must exist."""
    df, _, label = features.build_features(base.indexed_readings(spark, sf).drop("event_id"), READINGS)
    return df.select(*ROW, label)


# --- reports -------------------------------------------------------------------------


@query
def q1_missing_report(spark, sf):
    return profile.missing_report(_gappy_stations(spark, sf), STATIONS, STATION_SENSORS)


@query
def q2_cadence(spark, sf):
    return rounded(profile.cadence_report(base.indexed_readings(spark, sf), READINGS))


@query
def q3_coverage(spark, sf):
    return rounded(profile.coverage(base.readings(spark, sf), READINGS))


@query
def q4_labels(spark, sf):
    return profile.label_list(base.station_stacked(spark, sf), STATIONS)


@query
def q5_outliers(spark, sf):
    flagged = hampel.hampel(base.indexed_readings(spark, sf), READINGS)
    return rounded(profile.outlier_report(flagged, READINGS, f"{TARGET}_is_outlier"))


@query
def q6_status_counts(spark, sf):
    return rounded(profile.value_counts(a4_advisories(spark, sf), STATIONS, "status"))


@query
def q6_recommendation_counts(spark, sf):
    return rounded(profile.value_counts(a4_advisories(spark, sf), STATIONS, "recommendation"))


@query
def q7_status_labels(spark, sf):
    """Known statuses get their label and action, unknown ones a title and a default."""
    advised = a4_advisories(spark, sf)
    odd = F.when(F.col("predicted_moisture") > 80, "sensor offline").otherwise(F.col("status"))
    counted = profile.value_counts(advised.withColumn("status", odd), STATIONS, "status")
    return advise.describe_status(counted).drop("pct", "rank")


@query
def q8_split_spans(spark, sf):
    return profile.split_spans(split.chronological_split(base.readings(spark, sf), READINGS), READINGS)


@query
def q9_latest_advisories(spark, sf):
    return advise.latest(a4_advisories(spark, sf), STATIONS)


def _scored_splits(cleaned: DataFrame) -> DataFrame:
    """Clean stations, split, with the reading 24 rows ago as the forecast of now."""
    parts = split.chronological_split(cleaned, STATIONS)
    return index.over_chunks(
        parts, STATIONS, 24, 0, lambda d, w: d.withColumn("prediction", F.lag(TARGET, 24).over(w))
    ).na.drop(subset=["prediction"])


@query
def q10_run_summary(spark, sf):
    cleaned = base.station_clean(spark, sf)
    flagged = hampel.hampel(cleaned, STATIONS)
    scored = materialize(_scored_splits(cleaned))
    metrics = evaluate.evaluate(scored, ["station_id", "split"], TARGET, "prediction")
    advised = advise.advisories(scored.where("split = 'test'"), STATIONS)
    return rounded(
        profile.run_summary(cleaned, flagged, scored, metrics, advised, STATIONS, f"{TARGET}_is_outlier")
    )


@query
def q11_preview(spark, sf):
    return profile.preview(base.readings(spark, sf), READINGS, 20)


@query
def q11_shape(spark, sf):
    return profile.shape(base.readings(spark, sf))


# --- Hampel filter -------------------------------------------------------------------


def _median_and_mad(spark, sf) -> DataFrame:
    return hampel.with_median_and_mad(_gappy(spark, sf), READINGS, TARGET)


@query
def h1_rolling_median(spark, sf):
    return rounded(_median_and_mad(spark, sf).select(*ROW, F.col("_median").alias("rolling_median")))


@query
def h2_rolling_mad(spark, sf):
    return rounded(_median_and_mad(spark, sf).select(*ROW, F.col("_mad").alias("rolling_mad")))


@query
def h3_threshold(spark, sf):
    limit = hampel.hampel_threshold(F.col("_mad"))
    return rounded(_median_and_mad(spark, sf).select(*ROW, limit.alias("threshold")))


def _hampel(spark, sf) -> DataFrame:
    return hampel.hampel(_gappy(spark, sf), READINGS)


@query
def h4_outlier_flag(spark, sf):
    return _hampel(spark, sf).select(*ROW, F.col(f"{TARGET}_is_outlier").alias("is_outlier"))


@query
def h5_hampel_replace(spark, sf):
    return rounded(
        _hampel(spark, sf).select(
            *ROW,
            "timestamp",
            f"{TARGET}_raw",
            f"{TARGET}_hampel_cleaned",
            f"{TARGET}_is_outlier",
        )
    )


@query
def h6_hampel_any_column(spark, sf):
    """Another column, a narrower window and a lower sigma."""
    flagged = hampel.hampel(base.station_clean(spark, sf), STATIONS, "air_temperature", 5, 2.0)
    return rounded(
        flagged.select(
            *STATION_ROW, "air_temperature", "air_temperature_raw",
            "air_temperature_hampel_cleaned", "air_temperature_is_outlier",
        )
    )


@query
def h7_correction(spark, sf):
    changed = hampel.correction_magnitude(_hampel(spark, sf)).where(f"{TARGET}_correction > 0")
    return rounded(changed.select(*ROW, f"{TARGET}_correction"))


# --- decomposition and reconstruction --------------------------------------------------


@query
def c1_extrema(spark, sf):
    return decompose.extrema(base.indexed_readings(spark, sf), READINGS)


@query
def c2_envelopes(spark, sf):
    return rounded(decompose.envelopes(base.indexed_readings(spark, sf), READINGS))


@query
def c3_sift_once(spark, sf):
    return rounded(decompose.sift_once(base.indexed_readings(spark, sf), READINGS))


# Short blocks, so that series are split at every scale. An ensemble decomposes every trial, so its query that
# has a reference uses longer blocks, and the one without the default length.
SHORT_BLOCKS, TRIAL_BLOCKS, LONG_BLOCKS = SeriesSpec(block_rows=128), SeriesSpec(block_rows=1024), SeriesSpec()


@query
def c4_emd(spark, sf):
    return rounded(decompose.emd(base.indexed_readings(spark, sf), SHORT_BLOCKS))


@query
def c5_ceemdan(spark, sf):
    return decompose.ceemdan(base.indexed_readings(spark, sf), LONG_BLOCKS)


@query
def c5_components_sum(spark, sf):
    """The modes and the residue of every row add up to its reading."""
    parts = decompose.ceemdan(base.indexed_readings(spark, sf), TRIAL_BLOCKS)
    return rounded(parts.groupBy(*ROW).agg(F.sum("value").alias(TARGET)), 6)


@query
def c6_mode_columns(spark, sf):
    df = base.indexed_readings(spark, sf)
    modes = decompose.emd(df, SHORT_BLOCKS, max_imfs=4)
    return rounded(decompose.attach_modes(df, modes, SHORT_BLOCKS, count=3))


def _two_modes(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Readings and a two-part decomposition that needs no random numbers: one sift,
    rounded, and what it leaves."""
    df = base.indexed_readings(spark, sf)
    sifted = rounded(decompose.sift_once(df, READINGS))
    both = materialize(df.join(sifted, ROW))
    mode = both.select(*ROW, F.lit(1).alias("component"), F.col("sifted").alias("value"))
    rest = both.select(*ROW, F.lit(0).alias("component"), (F.col(TARGET) - F.col("sifted")).alias("value"))
    return both.drop("sifted"), mode.unionByName(rest)


def _statistics(spark, sf, significance: bool = False) -> DataFrame:
    df, modes = _two_modes(spark, sf)
    return reconstruct.mode_statistics(modes, df, READINGS, significance=significance)


@query
def r1_mode_statistics(spark, sf):
    return _statistics(spark, sf)


@query
def r2_p_values(spark, sf):
    return _statistics(spark, sf, significance=True)


@query
def r3_mode_selection(spark, sf):
    # A higher bar for correlation, so that some modes fail it.
    return reconstruct.select_modes(_statistics(spark, sf), 0.8, 60.0).select(
        "series_id", "component_name", "selected", "reason"
    )


@query
def r4_reconstruct(spark, sf):
    df, modes = _two_modes(spark, sf)
    chosen = reconstruct.select_modes(reconstruct.mode_statistics(modes, df, READINGS, significance=False), 0.8, 60.0)
    return rounded(reconstruct.reconstruct(modes, chosen, READINGS))


@query
def r5_extracted_noise(spark, sf):
    df, modes = _two_modes(spark, sf)
    chosen = reconstruct.select_modes(reconstruct.mode_statistics(modes, df, READINGS, significance=False), 0.8, 60.0)
    attached = reconstruct.attach_reconstruction(df, modes, chosen, READINGS)
    return rounded(attached.select(*ROW, TARGET, f"{TARGET}_reconstructed", f"{TARGET}_extracted_noise"))


# --- features ------------------------------------------------------------------------


def _windowed(df: DataFrame, spec, build, left: int = 24, right: int = 0, digits: int = 9) -> DataFrame:
    """Only what ``build`` adds; it returns columns, or the table with its new columns."""

    def add(padded, w):
        new = build(padded, w)
        return new if isinstance(new, DataFrame) else padded.withColumns(new)

    out = index.over_chunks(df, spec, left, right, add)
    return rounded(out.drop(*[c for c in df.columns if c not in (*spec.keys, spec.index)]), digits)


def _lead(padded, w):
    return features.lead_target(w)


def _lags(padded, w):
    return features.target_lags(w)


def _rolling(part: str):
    return lambda padded, w: features.with_rolling(padded, w, parts=[part])


@query
def f1_lead_target(spark, sf):
    return _windowed(base.indexed_readings(spark, sf), READINGS, _lead, 0, 24)


@query
def f2_hour_cycle(spark, sf):
    df = base.readings(spark, sf).withColumns(features.hour_cycle("timestamp"))
    return rounded(df.select("event_id", "hour_sin", "hour_cos"))


@query
def f3_month_cycle(spark, sf):
    df = base.table(spark, sf, "orders").withColumns(features.month_cycle("o_orderdate"))
    return rounded(df.select("o_orderkey", "month_sin", "month_cos"))


@query
def f4_weekday(spark, sf):
    df = base.table(spark, sf, "orders").withColumns(features.weekday_flags("o_orderdate"))
    return df.select("o_orderkey", "day_of_week", "is_weekend")


@query
def f5_target_lags(spark, sf):
    return _windowed(base.indexed_readings(spark, sf), READINGS, _lags)


@query
def f6_earth_temperature_lags(spark, sf):
    return _windowed(
        base.station_clean(spark, sf), STATIONS, lambda d, w: features.sensor_lags(w, ["earth_temperature"])
    )


@query
def f7_air_lags(spark, sf):
    return _windowed(
        base.station_clean(spark, sf),
        STATIONS,
        lambda d, w: features.sensor_lags(w, ["air_temperature", "air_humidity"]),
    )


@query
def f8_rolling_mean(spark, sf):
    return _windowed(base.indexed_readings(spark, sf), READINGS, _rolling("mean"))


@query
def f9_rolling_std(spark, sf):
    return _windowed(base.indexed_readings(spark, sf), READINGS, _rolling("std"), digits=6)


@query
def f10_rolling_extremes(spark, sf):
    return _windowed(base.indexed_readings(spark, sf), READINGS, _rolling("extremes"))


@query
def f11_rain_sums(spark, sf):
    rain = base.indexed_readings(spark, sf).withColumnRenamed(TARGET, "precipitation")
    return _windowed(rain, READINGS, lambda d, w: features.rain_sums(w), digits=6)


@query
def f12_signal_lags(spark, sf):
    """Lags of a denoised signal; here the Hampel-cleaned one stands in for it."""
    signal = _hampel(spark, sf).withColumn(f"{TARGET}_reconstructed", F.col(f"{TARGET}_hampel_cleaned"))
    return _windowed(signal, READINGS, lambda d, w: features.signal_lags(w))


@query
def f14_feature_table(spark, sf):
    df, names, label = features.build_features(base.station_clean(spark, sf).drop("source_sheet", "source_year"), STATIONS)
    spread = [c for c in names if "_std_" in c or c.endswith(("_sin", "_cos"))]
    tidy = df.withColumns({c: F.round(c, 6) for c in spread})
    return rounded(tidy.select(*STATION_ROW, *names, label))


# --- split and evaluation ------------------------------------------------------------


@query
def m1_chronological_split(spark, sf):
    parts = split.chronological_split(base.readings(spark, sf), READINGS)
    return parts.select(*ROW, "event_id", "split")


@query
def m1_pooled_split(spark, sf):
    """All series cut at the same times."""
    return split.pooled_split(base.readings(spark, sf), READINGS).select("series_id", "event_id", "split")


def _scored(spark, sf) -> DataFrame:
    parts = split.chronological_split(base.readings(spark, sf), READINGS)
    return index.over_chunks(
        parts, READINGS, 24, 0, lambda d, w: d.withColumn("prediction", F.lag(TARGET, 24).over(w))
    ).na.drop(subset=["prediction"])


@query
def e1_metrics(spark, sf):
    scored = _scored(spark, sf)
    return evaluate.evaluate(scored, ["series_id", "split"], TARGET, "prediction").drop("mape_pct")


@query
def e2_mape(spark, sf):
    scored = _scored(spark, sf)
    return scored.groupBy("series_id", "split").agg(evaluate.mape(TARGET, "prediction").alias("mape_pct"))


@query
def e3_all_splits(spark, sf):
    """The three splits over all series in one pass."""
    return evaluate.evaluate(_scored(spark, sf), ["split"], TARGET, "prediction")


def _residuals(spark, sf) -> DataFrame:
    return evaluate.residuals(_scored(spark, sf), [*ROW, "timestamp", "split"], TARGET, "prediction")


@query
def e4_residuals(spark, sf):
    return rounded(_residuals(spark, sf))


@query
def e5_residual_moments(spark, sf):
    return rounded(evaluate.residual_moments(_residuals(spark, sf), ["split"]), 6)


@query
def e6_residual_histogram(spark, sf):
    # Residuals are rounded first: an edge value must fall on the same side everywhere.
    return rounded(evaluate.residual_histogram(rounded(_residuals(spark, sf), 2), ["split"]))


# --- model and attribution -------------------------------------------------------------

#: Fitted models by application, tables and what they were fitted on.
_FITTED: dict[tuple, tuple[model.Fitted, DataFrame]] = {}


def _fitted(spark, sf) -> tuple[model.Fitted, DataFrame]:
    """The default model and its split rows, fitted once per application: the queries below only read it."""
    key = spark.sparkContext.applicationId, sf
    if key not in _FITTED:
        featured, names, label = features.build_features(base.indexed_readings(spark, sf).drop("event_id"), READINGS)
        splits = materialize(split.chronological_split(featured, READINGS))
        _FITTED[key] = model.train(splits, names, label), splits
    return _FITTED[key]


@query
def m2_forecast_quality(spark, sf):
    """Boosted trees fitted on the train rows, judged on all three splits."""
    fitted, splits = _fitted(spark, sf)
    scored = model.predict(fitted.model, splits)
    return evaluate.evaluate(scored, ["split"], features.lead_target_name(), "prediction")


@query
def m2_first_tree(spark, sf):
    """Every node of the first tree over the lags: 31 leaves, grown best-first."""

    def add(padded, w):
        return padded.withColumns(features.lead_target(w) | features.target_lags(w))

    lagged = index.over_chunks(base.indexed_readings(spark, sf).drop("event_id"), READINGS, 24, 24, add).na.drop()
    splits = materialize(split.chronological_split(lagged, READINGS))
    names = [TARGET, *(f"earth_humidity_lag_{k}h" for k in features.TARGET_LAGS)]
    fitted = model.train(splits, names, features.lead_target_name(), rounds=1, column_sample=1.0)
    return rounded(fitted.model.node_table(spark).drop("tree"), 6)


@query
def m3_early_stopping(spark, sf):
    """Train and validation error per trained round, and which rounds are kept."""
    fitted, _ = _fitted(spark, sf)
    curve = [
        (i + 1, float(t), float(v), i < fitted.best_rounds)
        for i, (t, v) in enumerate(zip(fitted.train_mse, fitted.validation_mse))
    ]
    return spark.createDataFrame(curve, "round int, train_mse double, validation_mse double, kept boolean")


@query
def m3_stop_rule(spark, sf):
    """Best round and stop of many error curves at once; here the days of a series and user block are its rounds."""
    events = base.table(spark, sf, "events")
    daily = events.groupBy(
        F.col("event_type").alias("series_id"), base.station_of(F.col("user_id")).alias("station_id"), F.to_date("ts").alias("day")
    ).agg(F.round(F.avg("value"), 6).alias("error"))
    order = Window.partitionBy("series_id", "station_id").orderBy("day")
    curves = daily.withColumn("round", F.row_number().over(order))
    return model.kept_rounds(curves, ["series_id", "station_id"], 5)


@query
def s12_model_sink(spark, sf):
    """Whether the model that was saved and loaded again predicts the same for every row."""
    fitted, splits = _fitted(spark, sf)
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    sinks.save_model(fitted.model, spark, path)
    scored = model.predict(fitted.model, splits).withColumnRenamed("prediction", "first")
    again = model.predict(sinks.load_model(spark, path), scored)
    return again.select(*ROW, "split", (F.col("first") == F.col("prediction")).alias("agrees"))


@query
def m4_predict(spark, sf):
    fitted, splits = _fitted(spark, sf)
    return model.predict(fitted.model, splits).select(*ROW, "split", features.lead_target_name(), "prediction")


@query
def m4_predicted_rows(spark, sf):
    """Which rows get a prediction, and in which split."""
    fitted, splits = _fitted(spark, sf)
    scored = model.predict(fitted.model, splits)
    return scored.select(*ROW, "split", F.col("prediction").isNotNull().alias("predicted"))


@query
def x1_sample(spark, sf):
    return attribute.sample_rows(base.indexed_readings(spark, sf), READINGS).select(*ROW, TARGET)


@query
def x2_contributions(spark, sf):
    """Shapley contributions of every test row."""
    fitted, splits = _fitted(spark, sf)
    return attribute.contributions(splits.where("split = 'test'"), fitted, READINGS)


@query
def x2_contributions_add_up(spark, sf):
    """Whether base value and contributions of every test row add up to its prediction."""
    fitted, splits = _fitted(spark, sf)
    test = splits.where("split = 'test'")
    parts = attribute.contributions(test, fitted, READINGS)
    total = parts.groupBy(*ROW).agg((F.max("base_value") + F.sum("contribution")).alias("total"))
    both = model.predict(fitted.model, test).join(total, ROW, "left")
    agrees = F.abs(F.col("total") - F.col("prediction")) < 1e-6
    return both.select(*ROW, F.coalesce(agrees, F.lit(False)).alias("agrees"))


def _stand_in_contributions(spark, sf) -> DataFrame:
    """A contribution table that plain SQL can rebuild: weighted distances to the lags."""
    lagged = index.over_chunks(
        base.indexed_readings(spark, sf), READINGS, 24, 0, lambda d, w: d.withColumns(features.target_lags(w))
    ).where("row_idx >= 24")
    names = [f"earth_humidity_lag_{k}h" for k in features.TARGET_LAGS]
    weight = F.pow(F.lit(0.5), F.length("feature") % 3) * F.when(F.col("feature") < "earth_humidity_lag_2", 1.0).otherwise(0.5)
    return lagged.unpivot([*ROW, TARGET], names, "feature", "value").withColumn(
        "contribution", (F.col("value") - F.col(TARGET)) * weight
    )


@query
def x3_importance(spark, sf):
    return rounded(attribute.importance(_stand_in_contributions(spark, sf), 5), 9)


@query
def q10_top_features(spark, sf):
    """The three most important features of each series, as the run summary names them."""
    return profile.top_features(_stand_in_contributions(spark, sf), READINGS)


@query
def x4_local_explanation(spark, sf):
    parts = _stand_in_contributions(spark, sf)
    return rounded(attribute.explain_row(parts, READINGS, F.lit(True), top=4))


@query
def x5_summary_points(spark, sf):
    points = attribute.summary_points(_stand_in_contributions(spark, sf), READINGS, 3)
    return rounded(points)


# --- advisories ----------------------------------------------------------------------


def _forecasts(spark, sf) -> DataFrame:
    return _scored_splits(base.station_clean(spark, sf)).where("split = 'test'")


@query
def a1_need(spark, sf):
    """Rules over every reading, with another reading of the row as the rain."""
    events = base.table(spark, sf, "events")
    rain = F.col("user_id").cast("double") / 10
    need = advise.irrigation_need(F.col("value"), rain)
    return events.select("event_id", need.alias("n")).select(
        "event_id", "n.predicted_moisture", "n.status", "n.recommendation", "n.urgency"
    )


@query
def a2_rationale(spark, sf):
    events = base.table(spark, sf, "events")
    need = advise.irrigation_need(F.col("value"), F.col("user_id").cast("double") / 10)
    return events.select("event_id", need.getField("agronomic_rationale").alias("agronomic_rationale"))


@query
def a3_station_thresholds(spark, sf):
    """Thresholds per event type from a table, defaults where the table has none."""
    events = base.table(spark, sf, "events")
    wetness = events.groupBy("event_type").agg(F.round(F.avg("value") / 2, 1).alias("irrigation_needed"))
    own = wetness.where("event_type <> 'error'")
    joined, thresholds = advise.join_thresholds(events, own, ["event_type"])
    need = advise.irrigation_need(F.col("value"), thresholds=thresholds)
    return joined.select("event_id", need.alias("n")).select("event_id", "n.status", "n.agronomic_rationale")


@query
def a4_advisories(spark, sf):
    return advise.advisories(_forecasts(spark, sf), STATIONS)
