"""For each query of the catalog, the same result as plain SQL over the same tables.

Written independently of the operators: whole-series windows and joins instead of
chunks, carries and buckets. Used to check results, never to compute them.
"""

from __future__ import annotations

SENSORS = {
    "earth_humidity": ("click", 0, 100),
    "earth_temperature": ("signup", -40, 70),
    "air_temperature": ("view", -40, 70),
    "air_humidity": ("purchase", 0, 100),
    "precipitation": ("error", 0, 500),
}
SENTINELS = "(-999, 999, -99, 9999, -9999)"
S = 'PARTITION BY series_id ORDER BY row_idx'
ST = 'PARTITION BY station_id ORDER BY row_idx'
BACK = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
AHEAD = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def each(template: str, columns=SENSORS, sep: str = ", ") -> str:
    return sep.join(template.replace("{c}", c) for c in columns)


def rnd(columns=SENSORS, digits: int = 9) -> str:
    return each("round({c}, %d) AS {c}" % digits, columns)


# --- base relations --------------------------------------------------------------------

READINGS = """readings AS (
  SELECT event_type AS series_id, ts AS "timestamp", value AS earth_humidity, event_id FROM events)"""
INDEXED = """indexed AS (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY "timestamp", event_id) - 1 AS row_idx
  FROM readings)"""
GAPPY = """gappy AS (
  SELECT series_id, "timestamp", event_id, row_idx,
    CASE WHEN earth_humidity BETWEEN 0 AND 100 THEN earth_humidity END AS earth_humidity FROM indexed)"""
STACKED = (
    "stacked AS (SELECT 'st' || (user_id // 100)::VARCHAR AS station_id, date_trunc('minute', ts) AS \"timestamp\", event_id, "
    + ", ".join(f"CASE WHEN event_type = '{kind}' THEN value END AS {c}" for c, (kind, _, _) in SENSORS.items())
    + ", CASE WHEN event_type IN ('click', 'signup') THEN 'soil' ELSE 'weather' END AS source_sheet, "
    "CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'early' ELSE 'late' END AS source_year FROM events)"
)
MERGED = f"""merged AS (SELECT station_id, "timestamp", {each('avg({c}) AS {c}')},
    arg_min(source_sheet, event_id) AS source_sheet, arg_min(source_year, event_id) AS source_year
  FROM stacked GROUP BY ALL)"""


def merged_from(condition: str) -> str:
    return MERGED.replace("FROM stacked", f"FROM stacked WHERE {condition}")


SANE = (
    "sane AS (SELECT * REPLACE ("
    + ", ".join(
        f"CASE WHEN {c} NOT IN {SENTINELS} AND {c} BETWEEN {lo} AND {hi} THEN {c} END AS {c}"
        for c, (_, lo, hi) in SENSORS.items()
    )
    + '), row_number() OVER (PARTITION BY station_id ORDER BY "timestamp") - 1 AS row_idx FROM merged)'
)
NEAR = "near AS (SELECT *, " + ", ".join(
    f"""last_value(CASE WHEN {c} IS NOT NULL THEN row_idx END IGNORE NULLS) OVER ({ST} {BACK}) AS pi_{c},
    last_value({c} IGNORE NULLS) OVER ({ST} {BACK}) AS pv_{c},
    first_value(CASE WHEN {c} IS NOT NULL THEN row_idx END IGNORE NULLS) OVER ({ST} {AHEAD}) AS ni_{c},
    first_value({c} IGNORE NULLS) OVER ({ST} {AHEAD}) AS nv_{c}"""
    for c in SENSORS
) + " FROM sane)"
LIMITED = "limited AS (SELECT station_id, \"timestamp\", row_idx, source_sheet, source_year, " + ", ".join(
    f"""CASE WHEN {c} IS NOT NULL THEN {c}
      WHEN pi_{c} IS NULL THEN CASE WHEN ni_{c} - row_idx <= 12 THEN nv_{c} END
      WHEN ni_{c} IS NULL THEN CASE WHEN row_idx - pi_{c} <= 12 THEN pv_{c} END
      WHEN least(row_idx - pi_{c}, ni_{c} - row_idx) <= 12
        THEN pv_{c} + (nv_{c} - pv_{c}) / (ni_{c} - pi_{c}) * (row_idx - pi_{c}) END AS {c}"""
    for c in SENSORS
) + " FROM near)"
ZEROED = "zeroed AS (SELECT * REPLACE (coalesce(precipitation, 0.0) AS precipitation) FROM limited)"
CLEAN = (
    'filled AS (SELECT * FROM (SELECT station_id, "timestamp", row_idx, source_sheet, source_year, '
    + ", ".join(
        f"""coalesce({c}, first_value({c} IGNORE NULLS) OVER ({ST} {AHEAD}),
        last_value({c} IGNORE NULLS) OVER ({ST} {BACK})) AS {c}"""
        for c in SENSORS
    )
    + " FROM zeroed) WHERE earth_humidity IS NOT NULL)"
)
TIDY = f"clean AS (SELECT * REPLACE ({each('floor({c} * 100 + 0.5::DOUBLE) / 100 AS {c}')}) FROM filled)"
STATION_CLEAN = (STACKED, MERGED, SANE, NEAR, LIMITED, ZEROED, CLEAN, TIDY)


def hampel(
    source: str, value: str = "earth_humidity", keys: str = "series_id", k: int = 12, sigma: str = "3.0",
    prefix: str = "",
) -> str:
    """Three CTEs ending in ``flagged``: rolling median, rolling MAD, decision."""
    w = f"OVER (PARTITION BY {keys} ORDER BY row_idx ROWS BETWEEN {k} PRECEDING AND {k} FOLLOWING)"
    return f"""{prefix}med AS (SELECT *, median({value}) {w} AS m FROM {source}),
{prefix}mad AS (SELECT *, median(abs({value} - m)) {w} AS d FROM {prefix}med),
{prefix}thr AS (SELECT *, CASE WHEN {sigma}::DOUBLE * 1.4826::DOUBLE * d = 0 THEN 1e-6::DOUBLE
    ELSE {sigma}::DOUBLE * 1.4826::DOUBLE * d END AS t FROM {prefix}mad),
{prefix}flagged AS (SELECT *, coalesce(abs({value} - m) > t, false) AS is_outlier,
    CASE WHEN abs({value} - m) > t THEN m ELSE {value} END AS fixed FROM {prefix}thr)"""


def splits(source: str, keys: str, order: str) -> str:
    return f"""numbered AS (SELECT * EXCLUDE (row_idx), row_number() OVER (PARTITION BY {keys} ORDER BY {order}) - 1 AS row_idx,
    count(*) OVER (PARTITION BY {keys}) AS n FROM {source}),
split_rows AS (SELECT *, CASE WHEN row_idx < floor(n * 0.70::DOUBLE) THEN 'train'
    WHEN row_idx < floor(n * (0.70::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM numbered),
lagged AS (SELECT *, lag(earth_humidity, 24) OVER (PARTITION BY {keys} ORDER BY row_idx) AS prediction FROM split_rows),
scored AS (SELECT * FROM lagged WHERE prediction IS NOT NULL)"""


READING_SPLITS = (READINGS, INDEXED, splits("indexed", "series_id", '"timestamp"'))
STATION_SPLITS = (*STATION_CLEAN, splits("clean", "station_id", '"timestamp"'))


def rule(m: str, rain: str, th: tuple[str, str, str] = ("20.0", "35.0", "65.0")) -> str:
    crit, need, top = th
    return f"""CASE WHEN {m} < {crit} THEN 1 WHEN {m} < {need} AND {rain} >= 5 THEN 2
    WHEN {m} < {need} THEN 3 WHEN {m} <= {top} THEN 4 ELSE 5 END"""


def by_rule(values: list[str], alias: str) -> str:
    return "CASE rule " + " ".join(f"WHEN {i + 1} THEN {v}" for i, v in enumerate(values)) + f" END AS {alias}"


STATUS = by_rule(
    ["'CRITICAL DEFICIT'", "'DEFICIT (RAIN EXPECTED)'", "'MOISTURE DEFICIT'", "'OPTIMAL MOISTURE'",
     "'SATURATION / EXCESS'"], "status")
RECOMMENDATION = by_rule(
    ["'Immediate Irrigation Urgently Required'", "'Hold Irrigation / Monitor Rain'", "'Irrigation Recommended'",
     "'No Irrigation Required'", "'Irrigation Prohibited (Risk of Waterlogging)'"], "recommendation")
URGENCY = by_rule(["'High'", "'Low'", "'Medium'", "'None'", "'None'"], "urgency")


def half_up(x: str, digits: int) -> str:
    """Decimal rounding of the printed double, ties away from zero."""
    return f"round(({x})::DOUBLE::VARCHAR::DECIMAL(38, 18), {digits})::DOUBLE"


def reason(m: str, rain: str, th: tuple[str, str, str] = ("'20.0'", "'35.0'", "'65.0'")) -> str:
    crit, need, top = th
    m1, r1 = (f"printf('%.1f', {half_up(x, 1)})" for x in (m, rain))
    return by_rule(
        [
            f"'Forecasted moisture (' || {m1} || '%) is below critical wilting threshold (' || {crit} || '%).'",
            f"'Moisture is low (' || {m1} || '%), but upcoming rainfall (' || {r1} || 'mm) will replenish soil.'",
            f"'Forecasted moisture (' || {m1} || '%) falls below optimal threshold (' || {need} || '%).'",
            f"'Forecasted moisture (' || {m1} || '%) is within optimal agronomic field capacity (' || {need} || '% - ' || {top} || '%).'",
            f"'Forecasted moisture (' || {m1} || '%) indicates near-saturated conditions (> ' || {top} || '%).'",
        ],
        "agronomic_rationale",
    )


ADVISED = f"""ruled AS (SELECT *, coalesce(precipitation, 0.0) AS rain,
    {rule('prediction', 'coalesce(precipitation, 0.0)')} AS rule FROM scored WHERE split = 'test'),
advised AS (SELECT station_id, "timestamp" AS current_timestamp_, "timestamp" + INTERVAL 24 HOUR AS forecast_target_time,
    {half_up('prediction', 2)} AS predicted_moisture, {STATUS}, {RECOMMENDATION}, {URGENCY}, {reason('prediction', 'rain')}
  FROM ruled)"""
ADVISORIES = (*STATION_SPLITS, ADVISED)
ADVISORY_COLUMNS = (
    'station_id, current_timestamp_ AS "current_timestamp", forecast_target_time, predicted_moisture, '
    "status, recommendation, urgency, agronomic_rationale"
)


def counts(column: str) -> str:
    return f"""counted AS (SELECT station_id, {column}, count(*) AS n_rows FROM advised GROUP BY ALL),
ranked AS (SELECT *, n_rows / sum(n_rows) OVER (PARTITION BY station_id) * 100 AS pct,
    row_number() OVER (PARTITION BY station_id ORDER BY n_rows DESC, {column}) AS rank FROM counted)"""


def windows(columns: dict[str, str], source: str, keys: str, digits: int = 9) -> str:
    over = f"PARTITION BY {keys} ORDER BY row_idx"

    def places(c: str) -> int:
        return 6 if "_std_" in c or c.endswith(("_sin", "_cos")) else digits

    picked = ", ".join(f"round({x.replace('@', over)}, {places(c)}) AS {c}" for c, x in columns.items())
    return f"SELECT {keys}, row_idx, {picked} FROM {source}"


def full(aggregate: str, column: str, n: int) -> str:
    frame = f"OVER (@ ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({column}) {frame} = {n} THEN {aggregate}({column}) {frame} END"


LEAD = {"target_24h_ahead": "lead(earth_humidity, 24) OVER (@)"}
TARGET_LAGS = {f"earth_humidity_lag_{k}h": f"lag(earth_humidity, {k}) OVER (@)" for k in (1, 2, 3, 6, 12, 24)}
EARTH_LAGS = {f"earth_temp_lag_{k}h": f"lag(earth_temperature, {k}) OVER (@)" for k in (1, 6, 12, 24)}
AIR_LAGS = {
    f"{c}_lag_{k}h": f"lag({c}, {k}) OVER (@)" for c in ("air_temperature", "air_humidity") for k in (1, 6, 24)
}
MEANS = {f"earth_humidity_roll_mean_{n}h": full("avg", "earth_humidity", n) for n in (6, 12, 24)}
STDS = {f"earth_humidity_roll_std_{n}h": full("stddev_samp", "earth_humidity", n) for n in (6, 12, 24)}
LOW, HIGH = full("min", "earth_humidity", 24), full("max", "earth_humidity", 24)
EXTREMES = {
    "earth_humidity_roll_min_24h": LOW,
    "earth_humidity_roll_max_24h": HIGH,
    "earth_humidity_daily_range": f"({HIGH}) - ({LOW})",
}


def rain(column: str) -> dict[str, str]:
    return {
        f"precip_accum_{n}h": f"sum({column}) OVER (@ ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for n in (6, 24)
    }


CALENDAR = {
    "hour_sin": "sin(2 * pi() * hour(\"timestamp\") / 24)",
    "hour_cos": "cos(2 * pi() * hour(\"timestamp\") / 24)",
    "month_sin": "sin(2 * pi() * (month(\"timestamp\") - 1) / 12)",
    "month_cos": "cos(2 * pi() * (month(\"timestamp\") - 1) / 12)",
}
WEEKDAY = 'isodow("timestamp") - 1'

METRICS = """round(avg(abs(earth_humidity - prediction)), 4) AS mae,
  round(sqrt(avg((earth_humidity - prediction) ** 2)), 4) AS rmse,
  round(1 - sum((earth_humidity - prediction) ** 2) / (count(*) * var_pop(earth_humidity)), 4) AS r2"""
MAPE = """round(coalesce(avg(abs((earth_humidity - prediction) / earth_humidity))
  FILTER (WHERE abs(earth_humidity) > 1e-4) * 100, 0), 2) AS mape_pct"""

FAULTY = """faulty AS (SELECT event_type AS series_id, event_id, CASE WHEN value < 3 THEN -999.0 WHEN value < 4 THEN 999.0
    WHEN value < 5 THEN -99.0 WHEN value > 300 THEN 9999.0 ELSE value END::DOUBLE AS v FROM events),
sick AS (SELECT series_id, event_id, v AS earth_humidity, v * 2 - 60 AS air_temperature, v + 690 AS air_pressure FROM faulty)"""
LIMITS = {"earth_humidity": (0, 100), "air_temperature": (-40, 70), "air_pressure": (700, 1150)}

SQL: dict[str, str] = {}

SQL["s3_stack_sheets"] = with_(STACKED) + (
    "SELECT station_id, strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS communicate_at, event_id, "
    + each("{c}::VARCHAR AS {c}")
    + ", source_sheet, source_year FROM stacked"
)
SQL["s2_csv_sheets"] = with_(STACKED) + (
    f'SELECT station_id, "timestamp", event_id, {each("{c}")}, source_sheet, source_year FROM stacked'
)
SQL["s8_mirrored_channels"] = with_(STACKED) + (
    "SELECT event_id, air_humidity AS earth_humidity, air_temperature AS earth_temperature, air_temperature, air_humidity, "
    "precipitation, 'abnormal_weather' AS source_sheet, 'Abnormal_Test' AS source_year FROM stacked "
    "WHERE source_sheet = 'weather' AND source_year = 'early'"
)
SQL["s10_series_sink"] = with_(*STATION_CLEAN) + (
    f"SELECT station_id, row_idx, \"timestamp\", {each('{c}')}, strftime(\"timestamp\", '%Y-%m') AS month FROM clean"
)
SQL["s5_snake_case"] = r"""SELECT page_id, regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(
    regexp_replace(url, '^\s+|\s+$', '', 'g'), '([a-z0-9])([A-Z])', '\1_\2', 'g'), '[\s.-]+', '_', 'g')),
    '_+', '_', 'g'), '^_|_$', '', 'g') AS plain_name FROM pages"""
SQL["s6_canonical_columns"] = """SELECT event_id AS station_id, ts AS communicate_at,
  coalesce(CASE WHEN value < 80 THEN value + 1 END, CASE WHEN value > 50 THEN value END) AS earth_humidity,
  user_id AS battery_voltage FROM events"""
SQL["s7_provenance"] = with_(STACKED) + "SELECT source_year, source_sheet, count(*) AS n_rows FROM stacked GROUP BY ALL"

TIMED = """timed AS (SELECT event_id, CASE WHEN event_type NOT IN ('signup', 'purchase') AND value > 200 THEN NULL
  ELSE date_trunc('second', ts) END AS "timestamp" FROM events)"""
SQL["p1_unify_timestamp"] = with_(TIMED) + "SELECT * FROM timed"
SQL["p2_drop_untimed"] = with_(TIMED) + 'SELECT * FROM timed WHERE "timestamp" IS NOT NULL'
SQL["p3_coerce_numbers"] = (
    "SELECT event_id, CASE WHEN value > 100 OR value < 1 THEN NULL ELSE value END AS air_temperature FROM events"
)
SQL["p4_sorted_positions"] = with_(READINGS, INDEXED) + 'SELECT series_id, row_idx, "timestamp", event_id FROM indexed'
SQL["p5_duplicate_count"] = with_(STACKED) + (
    'SELECT station_id, (count(*) - count(DISTINCT "timestamp"))::BIGINT AS duplicate_rows FROM stacked GROUP BY 1'
)
SQL["p6_deduplicate"] = with_(STACKED, MERGED) + (
    f'SELECT station_id, "timestamp", {rnd()}, source_sheet, source_year FROM merged'
)
SQL["p7_null_sentinels"] = with_(FAULTY) + (
    "SELECT series_id, event_id, " + each(f"CASE WHEN {{c}} NOT IN {SENTINELS} THEN {{c}} END AS {{c}}", LIMITS) + " FROM sick"
)
SQL["p8_null_out_of_bounds"] = with_(FAULTY) + (
    "SELECT series_id, event_id, "
    + ", ".join(f"CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END AS {c}" for c, (lo, hi) in LIMITS.items())
    + " FROM sick"
)
SQL["p8_void_counts"] = with_(FAULTY) + " UNION ALL ".join(
    f"""SELECT series_id, '{c}' AS column_name,
    count(*) FILTER (WHERE {c} IN {SENTINELS} OR {c} < {lo} OR {c} > {hi}) AS voided FROM sick GROUP BY 1"""
    for c, (lo, hi) in LIMITS.items()
)
SQL["p9_row_index"] = with_(STACKED) + (
    'SELECT station_id, event_id, row_number() OVER (PARTITION BY station_id ORDER BY "timestamp", event_id) - 1 AS row_idx, '
    "count(*) OVER (PARTITION BY station_id) AS n_rows FROM stacked"
)
SQL["p10_interpolate"] = with_(*STATION_CLEAN[:5]) + f"SELECT station_id, row_idx, {rnd()} FROM limited"
SQL["p11_zero_rain"] = with_(*STATION_CLEAN[:6]) + f"SELECT station_id, row_idx, {rnd(['precipitation'])} FROM zeroed"
SQL["p12_fill_edges"] = with_(*STATION_CLEAN[:4]) + (
    "SELECT station_id, row_idx, "
    + each("round(coalesce({c}, nv_{c}, pv_{c}), 9) AS {c}")
    + " FROM near"
)
SQL["p13_require_target"] = with_(READINGS, INDEXED, GAPPY) + (
    "SELECT series_id, row_idx, earth_humidity FROM gappy WHERE earth_humidity IS NOT NULL"
)
CLEANED = f'SELECT station_id, row_idx, "timestamp", {rnd()}, source_sheet, source_year FROM filled'
SQL["p14_clean"] = with_(*STATION_CLEAN) + CLEANED
SQL["p15_combine_and_clean"] = SQL["p14_clean"]
SQL["p15_preprocess_single"] = (
    with_(STACKED, merged_from("source_year = 'early'"), SANE, NEAR, LIMITED, ZEROED, CLEAN) + CLEANED
)
SQL["p16_keep_raw"] = with_(READINGS, INDEXED, hampel("indexed")) + (
    "SELECT series_id, row_idx, round(fixed, 9) AS earth_humidity, earth_humidity AS earth_humidity_raw, "
    "round(fixed, 9) AS earth_humidity_hampel_cleaned, is_outlier AS earth_humidity_is_outlier FROM flagged"
)
SQL["p17_complete_rows"] = with_(READINGS, INDEXED) + (
    "SELECT * FROM (SELECT series_id, row_idx, lead(earth_humidity, 24) OVER (PARTITION BY series_id ORDER BY row_idx) "
    "AS target_24h_ahead FROM indexed) WHERE row_idx >= 24 AND target_24h_ahead IS NOT NULL"
)

SQL["q1_missing_report"] = with_(*STATION_CLEAN[:3]) + (
    "SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT station_id, count(*) AS total_rows, '{c}' AS column_name, count(*) - count({c}) AS missing_count,
        round((count(*) - count({c})) / count(*) * 100, 2) AS missing_pct FROM sane GROUP BY 1""" for c in SENSORS
    ) + ") WHERE missing_count > 0"
)
SQL["q2_cadence"] = with_(READINGS, INDEXED) + f"""SELECT series_id, round(m / 1e6::DOUBLE, 9) AS median_seconds,
  round(min(step) / 1e6::DOUBLE, 9) AS min_seconds, round(max(step) / 1e6::DOUBLE, 9) AS max_seconds,
  count(*) FILTER (WHERE step > 2 * m) AS large_gaps
FROM (SELECT *, median(step) OVER (PARTITION BY series_id) AS m FROM (
  SELECT series_id, epoch_us("timestamp") - lag(epoch_us("timestamp")) OVER ({S}) AS step FROM indexed))
GROUP BY series_id, m"""
SQL["q3_coverage"] = with_(READINGS) + """SELECT series_id, count(*) AS n_rows, min("timestamp") AS coverage_start,
  max("timestamp") AS coverage_end,
  round((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 86400000000, 9) AS coverage_days,
  round((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 86400000000 / 365.25, 9) AS coverage_years
FROM readings GROUP BY 1"""
SQL["q4_labels"] = with_(STACKED) + (
    "SELECT station_id, string_agg(DISTINCT source_year, ' & ' ORDER BY source_year) AS labels FROM stacked GROUP BY 1"
)
SQL["q5_outliers"] = with_(READINGS, INDEXED, hampel("indexed")) + (
    "SELECT series_id, count(*) FILTER (WHERE is_outlier) AS outliers, count(*) AS n_rows, "
    "round(count(*) FILTER (WHERE is_outlier) / count(*) * 100, 9) AS outlier_pct FROM flagged GROUP BY 1"
)
for short in ("status", "recommendation"):
    SQL[f"q6_{short}_counts"] = with_(*ADVISORIES, counts(short)) + (
        f"SELECT station_id, {short}, n_rows, round(pct, 9) AS pct, rank FROM ranked"
    )
SQL["q7_status_labels"] = with_(*ADVISORIES) + """SELECT station_id, status, n_rows,
  CASE status WHEN 'CRITICAL DEFICIT' THEN 'Critically Dry' WHEN 'MOISTURE DEFICIT' THEN 'Moderate Deficit'
    WHEN 'DEFICIT (RAIN EXPECTED)' THEN 'Deficit (Rain Expected)' WHEN 'OPTIMAL MOISTURE' THEN 'Optimal'
    WHEN 'SATURATION / EXCESS' THEN 'Saturated' ELSE 'Sensor Offline' END AS status_label,
  CASE status WHEN 'CRITICAL DEFICIT' THEN 'Immediate watering required - saves crops'
    WHEN 'MOISTURE DEFICIT' THEN 'Scheduled watering recommended'
    WHEN 'DEFICIT (RAIN EXPECTED)' THEN 'Hold irrigation and monitor rain'
    WHEN 'OPTIMAL MOISTURE' THEN 'No irrigation needed - saves water'
    WHEN 'SATURATION / EXCESS' THEN 'Do not water - prevents root damage'
    ELSE 'Review the generated advisory details' END AS status_action
FROM (SELECT station_id, CASE WHEN predicted_moisture > 80 THEN 'sensor offline' ELSE status END AS status, count(*) AS n_rows
  FROM advised GROUP BY ALL)"""
SQL["q8_split_spans"] = with_(*READING_SPLITS) + """SELECT series_id, split, min("timestamp") AS first_time,
  max("timestamp") AS last_time, count(*) AS n_rows FROM split_rows GROUP BY ALL"""
SQL["q9_latest_advisories"] = with_(*ADVISORIES) + (
    f"SELECT {ADVISORY_COLUMNS} FROM advised ORDER BY current_timestamp_ DESC, station_id LIMIT 10"
)
SQL["q10_run_summary"] = with_(
    *ADVISORIES,
    hampel("clean", keys="station_id", prefix="h_"),
    counts("status"),
    """spans AS (SELECT station_id, min("timestamp") FILTER (WHERE split = 'train') AS train_start,
    max("timestamp") FILTER (WHERE split = 'train') AS train_end, min("timestamp") FILTER (WHERE split = 'test') AS test_start,
    max("timestamp") FILTER (WHERE split = 'test') AS test_end FROM scored GROUP BY 1)""",
    f"quality AS (SELECT station_id, {METRICS} FROM scored WHERE split = 'test' GROUP BY 1)",
    """cover AS (SELECT station_id, count(*) AS n_rows, min("timestamp") AS coverage_start, max("timestamp") AS coverage_end,
    string_agg(DISTINCT source_year, ' & ' ORDER BY source_year) AS labels FROM clean GROUP BY 1)""",
    """spikes AS (SELECT station_id, count(*) FILTER (WHERE is_outlier) AS outliers,
    round(count(*) FILTER (WHERE is_outlier) / count(*) * 100, 9) AS outlier_pct FROM h_flagged GROUP BY 1)""",
) + """SELECT station_id, n_rows, coverage_start, coverage_end,
  round((epoch_us(coverage_end) - epoch_us(coverage_start)) / 86400000000, 9) AS coverage_days,
  round((epoch_us(coverage_end) - epoch_us(coverage_start)) / 86400000000 / 365.25, 9) AS coverage_years,
  labels, outliers, outlier_pct, train_start, train_end, test_start, test_end, mae, rmse, r2, round(r2 * 100, 9) AS r2_pct,
  main_status, main_status_pct
FROM cover JOIN spikes USING (station_id) JOIN spans USING (station_id) JOIN quality USING (station_id)
JOIN (SELECT station_id, status AS main_status, round(pct, 9) AS main_status_pct FROM ranked WHERE rank = 1) USING (station_id)"""
SQL["q11_preview"] = with_(READINGS) + 'SELECT * FROM readings ORDER BY series_id, "timestamp" LIMIT 20'
SQL["q11_shape"] = "SELECT count(*) AS n_rows, 4::BIGINT AS n_columns FROM events"

GAPPY_HAMPEL = (READINGS, INDEXED, GAPPY, hampel("gappy"))
for name, column, alias in (
    ("h1_rolling_median", "round(m, 9)", "rolling_median"),
    ("h2_rolling_mad", "round(d, 9)", "rolling_mad"),
    ("h3_threshold", "round(t, 9)", "threshold"),
    ("h4_outlier_flag", "is_outlier", "is_outlier"),
):
    SQL[name] = with_(*GAPPY_HAMPEL) + f"SELECT series_id, row_idx, {column} AS {alias} FROM flagged"
SQL["h5_hampel_replace"] = with_(*GAPPY_HAMPEL) + (
    'SELECT series_id, row_idx, "timestamp", earth_humidity AS earth_humidity_raw, '
    "round(fixed, 9) AS earth_humidity_hampel_cleaned, is_outlier AS earth_humidity_is_outlier FROM flagged"
)
SQL["h6_hampel_any_column"] = with_(*STATION_CLEAN, hampel("clean", "air_temperature", "station_id", 5, "2.0")) + (
    "SELECT station_id, row_idx, round(fixed, 9) AS air_temperature, round(air_temperature, 9) AS air_temperature_raw, "
    "round(fixed, 9) AS air_temperature_hampel_cleaned, is_outlier AS air_temperature_is_outlier FROM flagged"
)
SQL["h7_correction"] = with_(*GAPPY_HAMPEL) + (
    "SELECT series_id, row_idx, round(abs(earth_humidity - fixed), 9) AS earth_humidity_correction FROM flagged "
    "WHERE abs(earth_humidity - fixed) > 0"
)

TURNS = """steps AS (SELECT series_id, row_idx, earth_humidity AS v,
    CASE WHEN earth_humidity IS DISTINCT FROM lag(earth_humidity) OVER (PARTITION BY series_id ORDER BY row_idx) THEN 1 ELSE 0 END AS brk
  FROM indexed),
flat AS (SELECT series_id, v, run, min(row_idx) AS a, max(row_idx) AS b
  FROM (SELECT *, sum(brk) OVER (PARTITION BY series_id ORDER BY row_idx) AS run FROM steps) GROUP BY series_id, v, run),
turns AS (SELECT series_id, (a + b) // 2 AS row_idx, v, lag(v) OVER (PARTITION BY series_id ORDER BY run) AS pv,
    lead(v) OVER (PARTITION BY series_id ORDER BY run) AS nv FROM flat),
ext AS (SELECT series_id, row_idx, 'peak' AS kind FROM turns WHERE pv < v AND nv < v
  UNION ALL SELECT series_id, row_idx, 'trough' FROM turns WHERE pv > v AND nv > v)"""
ENVELOPES = """pts AS (SELECT series_id, row_idx, earth_humidity AS v, p.kind IS NOT NULL AS is_peak, q.kind IS NOT NULL AS is_trough,
    CASE WHEN p.kind IS NOT NULL OR row_idx IN (0, n - 1) THEN row_idx END AS pk,
    CASE WHEN q.kind IS NOT NULL OR row_idx IN (0, n - 1) THEN row_idx END AS tr
  FROM (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM indexed)
  LEFT JOIN (FROM ext WHERE kind = 'peak') p USING (series_id, row_idx)
  LEFT JOIN (FROM ext WHERE kind = 'trough') q USING (series_id, row_idx)),
""" + "near AS (SELECT *, " + ", ".join(
    f"""last_value({k} IGNORE NULLS) OVER ({S} {BACK}) AS pi_{k},
    last_value(CASE WHEN {k} IS NOT NULL THEN v END IGNORE NULLS) OVER ({S} {BACK}) AS pv_{k},
    first_value({k} IGNORE NULLS) OVER ({S} {AHEAD}) AS ni_{k},
    first_value(CASE WHEN {k} IS NOT NULL THEN v END IGNORE NULLS) OVER ({S} {AHEAD}) AS nv_{k}"""
    for k in ("pk", "tr")
) + " FROM pts),\nenv AS (SELECT series_id, row_idx, v, is_peak, is_trough, " + ", ".join(
    f"CASE WHEN ni_{k} = pi_{k} THEN v ELSE pv_{k} + (nv_{k} - pv_{k}) / (ni_{k} - pi_{k}) * (row_idx - pi_{k}) END AS {n}"
    for k, n in (("pk", "upper"), ("tr", "lower"))
) + " FROM near)"
SIFTED = """sifted AS (SELECT series_id, row_idx, v, round(CASE WHEN least(
    count(*) FILTER (WHERE is_peak) OVER (PARTITION BY series_id),
    count(*) FILTER (WHERE is_trough) OVER (PARTITION BY series_id)) >= 3 THEN v - (upper + lower) / 2 ELSE v END, 9) AS h FROM env)"""
SIFT = (READINGS, INDEXED, TURNS, ENVELOPES, SIFTED)
SQL["c1_extrema"] = with_(READINGS, INDEXED, TURNS) + "SELECT series_id, row_idx, kind FROM ext"
SQL["c2_envelopes"] = with_(*SIFT[:4]) + (
    'SELECT series_id, row_idx, round("upper", 9) AS "upper", round("lower", 9) AS "lower" FROM env'
)
SQL["c3_sift_once"] = with_(*SIFT) + "SELECT series_id, row_idx, h AS sifted FROM sifted"


def _counted(source: str, name: str) -> str:
    """Runs, extrema and their number per series for signal ``h`` of ``source``."""
    return f"""{name}_runs AS MATERIALIZED (SELECT series_id, h, run, min(row_idx) AS a, max(row_idx) AS b FROM (
    SELECT *, sum(brk) OVER (PARTITION BY series_id ORDER BY row_idx) AS run FROM (SELECT *,
      CASE WHEN h IS DISTINCT FROM lag(h) OVER (PARTITION BY series_id ORDER BY row_idx) THEN 1 ELSE 0 END AS brk
    FROM {source})) GROUP BY series_id, h, run),
{name}_turns AS MATERIALIZED (SELECT series_id, (a + b) // 2 AS row_idx, sign AS kind FROM (SELECT *, CASE
    WHEN h > lag(h) OVER r AND h > lead(h) OVER r THEN 1 WHEN h < lag(h) OVER r AND h < lead(h) OVER r THEN -1 END AS sign
  FROM {name}_runs WINDOW r AS (PARTITION BY series_id ORDER BY run)) WHERE sign IS NOT NULL)"""


def _sifted(source: str, name: str) -> str:
    """One sift of signal ``h`` of ``source`` (series_id, row_idx, n, h) into ``name``."""
    kinds = (("pk", 1), ("tr", -1))
    near = ", ".join(
        f"""last_value({k} IGNORE NULLS) OVER b AS pi_{k}, last_value(CASE WHEN {k} IS NOT NULL THEN h END IGNORE NULLS) OVER b AS pv_{k},
      first_value({k} IGNORE NULLS) OVER f AS ni_{k}, first_value(CASE WHEN {k} IS NOT NULL THEN h END IGNORE NULLS) OVER f AS nv_{k}"""
        for k, _ in kinds
    )
    line = {
        k: f"CASE WHEN ni_{k} = pi_{k} THEN h ELSE pv_{k} + (nv_{k} - pv_{k}) / (ni_{k} - pi_{k}) * (row_idx - pi_{k}) END"
        for k, _ in kinds
    }
    return f"""{_counted(source, name)},
{name} AS MATERIALIZED (SELECT series_id, row_idx, n,
    CASE WHEN least(n_up, n_down) >= 3 THEN h - ({line["pk"]} + {line["tr"]}) / 2 ELSE h END AS h
  FROM (SELECT *, {near} FROM (SELECT s.*, n_up, n_down,
      CASE WHEN kind = 1 OR row_idx IN (0, n - 1) THEN row_idx END AS pk,
      CASE WHEN kind = -1 OR row_idx IN (0, n - 1) THEN row_idx END AS tr
    FROM {source} s LEFT JOIN {name}_turns USING (series_id, row_idx)
    LEFT JOIN (SELECT series_id, count(*) FILTER (WHERE kind = 1) AS n_up, count(*) FILTER (WHERE kind = -1) AS n_down
      FROM {name}_turns GROUP BY 1) USING (series_id))
    WINDOW b AS ({S} {BACK}), f AS ({S} {AHEAD})))"""


def decomposition(modes: int) -> tuple[list[str], str]:
    """CTEs that sift out ``modes`` modes, and the union of all components (0: residue)."""
    ctes = [READINGS, INDEXED, """x1 AS MATERIALIZED (SELECT series_id, row_idx, count(*) OVER (PARTITION BY series_id) AS n,
    earth_humidity AS h FROM indexed)"""]
    parts = []
    for m in range(1, modes + 1):
        for step in range(1, 9):
            ctes.append(_sifted(f"x{m}" if step == 1 else f"m{m}_{step - 1}", f"m{m}_{step}"))
        ctes.append(
            f"""rest{m} AS MATERIALIZED (SELECT series_id, row_idx, a.n, a.h - b.h AS h
    FROM x{m} a JOIN m{m}_8 b USING (series_id, row_idx))"""
        )
        ctes.append(_counted(f"rest{m}", f"left{m}"))
        going = f"(SELECT series_id FROM left{m}_turns GROUP BY 1 HAVING count(*) > 2)"
        ctes.append(f"x{m + 1} AS MATERIALIZED (FROM rest{m} WHERE series_id IN {going})")
        parts.append(f"SELECT series_id, row_idx, {m} AS component, h FROM m{m}_8")
        parts.append(f"SELECT series_id, row_idx, 0, h FROM rest{m} WHERE series_id NOT IN {going}")
    parts.append(f"SELECT series_id, row_idx, 0, h FROM x{modes + 1}")
    return ctes, " UNION ALL ".join(parts)


EMD_CTES, EMD_PARTS = decomposition(5)
SQL["c4_emd"] = with_(*EMD_CTES) + (
    f"SELECT series_id, row_idx, component, round(h, 9) AS value FROM ({EMD_PARTS})"
)
SQL["c5_components_sum"] = with_(READINGS, INDEXED) + (
    "SELECT series_id, row_idx, round(earth_humidity, 6) AS earth_humidity FROM indexed"
)
EMD_CTES, EMD_PARTS = decomposition(3)
SQL["c6_mode_columns"] = with_(*EMD_CTES, f"parts AS MATERIALIZED ({EMD_PARTS})") + (
    'SELECT series_id, row_idx, "timestamp", event_id, earth_humidity, '
    + ", ".join(
        f"round(max(h) FILTER (WHERE component = {k}), 9) AS {name}"
        for k, name in ((1, "imf_1"), (2, "imf_2"), (3, "imf_3"), (0, "imf_residue"))
    )
    + " FROM indexed JOIN parts USING (series_id, row_idx) GROUP BY ALL"
)
STATISTICS = """modes AS (SELECT series_id, row_idx, v, 1 AS component, h AS x FROM sifted
  UNION ALL SELECT series_id, row_idx, v, 0, v - h FROM sifted),
stats AS (SELECT series_id, component, CASE component WHEN 0 THEN 'Residue' ELSE 'IMF ' || component END AS component_name,
    round(var_pop(x), 4) AS variance, round(stddev_pop(x), 4) AS std_dev, round(sum(x * x), 2) AS energy,
    round(sum(x * x) / sum(sum(x * x)) OVER (PARTITION BY series_id) * 100, 2) AS energy_pct,
    round(corr(x, v), 4) AS pearson_r FROM modes GROUP BY series_id, component),
picked AS (SELECT *, component = 0 OR abs(pearson_r) >= 0.8 OR energy_pct >= 60 AS selected FROM stats),
joined AS (SELECT series_id, row_idx, v, sum(x) FILTER (WHERE selected) AS recon
  FROM modes JOIN picked USING (series_id, component) GROUP BY series_id, row_idx, v)"""
RECON = (*SIFT, STATISTICS)
SQL["r1_mode_statistics"] = with_(*RECON) + "SELECT * FROM stats"
# Two-sided p-values: r = sin(t), and t has a density proportional to cos(t)^(n - 3).
_SIMPSON = """(list_sum(list_transform(range(0, 401), lambda k:
    CASE WHEN k = 0 OR k = 400 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END * pow(cos({lo} + k * ({hi} - {lo}) / 400), n - 3))) * ({hi} - {lo}) / 1200)"""
SQL["r2_p_values"] = with_(*SIFT, STATISTICS, """exact AS (SELECT series_id, component, asin(abs(corr(x, v))) AS least, count(*) AS n,
    least(pi() / 2, 12 / sqrt(greatest(count(*) - 3, 1))) AS most FROM modes GROUP BY ALL)""") + f"""
SELECT stats.*, round(CASE WHEN least >= most THEN 0 ELSE
  {_SIMPSON.format(lo="least", hi="most")} / {_SIMPSON.format(lo="0", hi="most")} END, 6) AS p_value
FROM stats JOIN exact USING (series_id, component)"""
STRENGTH = (f"printf('%.3f', {half_up('abs(pearson_r)', 3)})", f"printf('%.1f', {half_up('energy_pct', 1)})")
SQL["r3_mode_selection"] = with_(*RECON) + f"""SELECT series_id, component_name, selected,
  CASE WHEN component = 0 THEN 'Residue Trend'
    WHEN selected THEN '|r|=' || {STRENGTH[0]} || ' >= 0.8 or E%=' || {STRENGTH[1]} || '%'
    ELSE 'High-frequency stochastic noise, |r|=' || {STRENGTH[0]} || ', E%=' || {STRENGTH[1]} || '%' END AS reason FROM picked"""
SQL["r4_reconstruct"] = with_(*RECON) + "SELECT series_id, row_idx, round(recon, 9) AS reconstructed FROM joined"
SQL["r5_extracted_noise"] = with_(*RECON) + (
    "SELECT series_id, row_idx, v AS earth_humidity, round(recon, 9) AS earth_humidity_reconstructed, "
    "round(v - recon, 9) AS earth_humidity_extracted_noise FROM joined"
)

SQL["f1_lead_target"] = with_(READINGS, INDEXED) + windows(LEAD, "indexed", "series_id")
SQL["f2_hour_cycle"] = """SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 9) AS hour_sin,
  round(cos(2 * pi() * hour(ts) / 24), 9) AS hour_cos FROM events"""
SQL["f3_month_cycle"] = """SELECT o_orderkey, round(sin(2 * pi() * (month(o_orderdate) - 1) / 12), 9) AS month_sin,
  round(cos(2 * pi() * (month(o_orderdate) - 1) / 12), 9) AS month_cos FROM orders"""
SQL["f4_weekday"] = """SELECT o_orderkey, (isodow(o_orderdate) - 1)::INTEGER AS day_of_week,
  (isodow(o_orderdate) >= 6)::INTEGER AS is_weekend FROM orders"""
SQL["f5_target_lags"] = with_(READINGS, INDEXED) + windows(TARGET_LAGS, "indexed", "series_id")
SQL["f6_earth_temperature_lags"] = with_(*STATION_CLEAN) + windows(EARTH_LAGS, "clean", "station_id")
SQL["f7_air_lags"] = with_(*STATION_CLEAN) + windows(AIR_LAGS, "clean", "station_id")
SQL["f8_rolling_mean"] = with_(READINGS, INDEXED) + windows(MEANS, "indexed", "series_id")
SQL["f9_rolling_std"] = with_(READINGS, INDEXED) + windows(STDS, "indexed", "series_id", 6)
SQL["f10_rolling_extremes"] = with_(READINGS, INDEXED) + windows(EXTREMES, "indexed", "series_id")
SQL["f11_rain_sums"] = with_(READINGS, INDEXED) + windows(rain("earth_humidity"), "indexed", "series_id", 6)
SQL["f12_signal_lags"] = with_(*GAPPY_HAMPEL) + windows(
    {f"earth_humidity_reconstructed_lag_{k}h": f"lag(fixed, {k}) OVER (@)" for k in (1, 24)}, "flagged", "series_id"
)
ALL_FEATURES = (
    {c: c for c in SENSORS} | LEAD | TARGET_LAGS | EARTH_LAGS | AIR_LAGS | MEANS | STDS | EXTREMES
    | rain("precipitation") | CALENDAR
)
SQL["f14_feature_table"] = with_(*STATION_CLEAN) + (
    "SELECT * FROM ("
    + windows(ALL_FEATURES, "clean", "station_id").replace(
        " FROM clean", f", ({WEEKDAY})::INTEGER AS day_of_week, ({WEEKDAY} >= 5)::INTEGER AS is_weekend FROM clean")
    + ") WHERE row_idx >= 24 AND target_24h_ahead IS NOT NULL"
)

SQL["m1_chronological_split"] = with_(*READING_SPLITS) + "SELECT series_id, row_idx, event_id, split FROM split_rows"
SQL["e1_metrics"] = with_(*READING_SPLITS) + (
    f"SELECT series_id, split, count(*) AS n_rows, {METRICS} FROM scored GROUP BY ALL"
)
SQL["e2_mape"] = with_(*READING_SPLITS) + f"SELECT series_id, split, {MAPE} FROM scored GROUP BY ALL"
SQL["e3_all_splits"] = with_(*READING_SPLITS) + (
    f"SELECT split, count(*) AS n_rows, {METRICS}, {MAPE} FROM scored GROUP BY ALL"
)
SQL["s11_metrics_sink"] = SQL["e3_all_splits"]
RESIDUALS = 'res AS (SELECT series_id, row_idx, "timestamp", split, prediction AS predicted, earth_humidity - prediction AS residual FROM scored)'
SQL["e4_residuals"] = with_(*READING_SPLITS, RESIDUALS) + "SELECT * REPLACE (round(residual, 9) AS residual) FROM res"
SQL["e5_residual_moments"] = with_(*READING_SPLITS, RESIDUALS) + (
    "SELECT split, round(avg(residual), 6) AS residual_mean, round(stddev_pop(residual), 6) AS residual_std FROM res GROUP BY 1"
)
SQL["e6_residual_histogram"] = with_(
    *READING_SPLITS,
    RESIDUALS,
    "tidy AS (SELECT split, round(residual, 2) AS r FROM res)",
    "ends AS (SELECT split, min(r) AS lo, max(r) AS hi, count(*) AS n FROM tidy GROUP BY 1)",
) + """SELECT split, bin, count(*) AS n_rows, round(lo + bin * ((hi - lo) / 40), 9) AS bin_start,
  round(count(*) / (n * ((hi - lo) / 40)), 9) AS density
FROM (SELECT *, least(floor((r - lo) / (hi - lo) * 40), 39)::BIGINT AS bin FROM tidy JOIN ends USING (split))
GROUP BY split, bin, lo, hi, n"""

# Rows with every lag and a target, numbered anew.
MODEL_ROWS = """model_rows AS (SELECT series_id, row_idx, CASE WHEN row_idx < floor(n * 0.7::DOUBLE) THEN 'train'
    WHEN row_idx < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT series_id, row_idx - 24 AS row_idx, total - 48 AS n
    FROM (SELECT *, count(*) OVER (PARTITION BY series_id) AS total FROM indexed) WHERE row_idx BETWEEN 24 AND total - 25))"""
SQL["m4_predicted_rows"] = with_(READINGS, INDEXED, MODEL_ROWS) + "SELECT *, true AS predicted FROM model_rows"
SQL["s12_model_sink"] = with_(READINGS, INDEXED, MODEL_ROWS) + "SELECT *, true AS agrees FROM model_rows"
SQL["m1_pooled_split"] = with_(
    READINGS,
    """times AS (SELECT "timestamp", row_number() OVER (ORDER BY "timestamp") - 1 AS k, count(*) OVER () AS n
  FROM (SELECT DISTINCT "timestamp" FROM readings))""",
) + """SELECT series_id, event_id, CASE WHEN k < floor(n * 0.7::DOUBLE) THEN 'train'
    WHEN k < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split
FROM readings JOIN times USING ("timestamp")"""
SQL["m3_stop_rule"] = """WITH daily AS (
  SELECT event_type AS series_id, 'st' || (user_id // 100)::VARCHAR AS station_id, ts::DATE AS day, round(avg(value), 6) AS error
  FROM events GROUP BY ALL),
curves AS (SELECT *, row_number() OVER (PARTITION BY series_id, station_id ORDER BY day) AS round FROM daily),
seen AS (SELECT *, arg_min(round, error) OVER (
    PARTITION BY series_id, station_id ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best FROM curves),
stops AS (SELECT series_id, station_id, coalesce(min(round) FILTER (round - best >= 5), max(round)) AS stop_round
  FROM seen GROUP BY ALL)
SELECT series_id, station_id, best::INT AS best_round, stop_round::INT AS stop_round
FROM stops JOIN seen USING (series_id, station_id) WHERE round = stop_round"""


def first_tree(columns: tuple[str, ...], leaves: int = 31, depth: int = 7, least: int = 20) -> str:
    """A regression tree over ``learn``: every node that can be parted, level by level, then the best ones first."""
    bound = ", ".join(
        f"list_sort(list_distinct(quantile_disc({c}, [k / 256 for k in range(1, 256)]))) AS b{k}"
        for k, c in enumerate(columns)
    )
    bins = ", ".join(f"len(list_filter(b{k}, lambda t: t < {c})) AS c{k}" for k, c in enumerate(columns))
    cells = " UNION ALL ".join(f"SELECT r, g, {k} AS f, c{k} AS b FROM binned" for k in range(len(columns)))
    at = "CASE f " + " ".join(f"WHEN {k} THEN c{k}" for k in range(len(columns))) + " END"
    parts = [
        f"bounds AS MATERIALIZED (SELECT {bound} FROM learn)",
        "unit AS MATERIALIZED (SELECT pow(2, 23 - ceil(log2(max(abs(y))))) AS u FROM learn)",
        "whole AS (SELECT *, floor(y * u + 0.5::DOUBLE)::BIGINT AS q FROM learn, unit)",
        "mean AS MATERIALIZED (SELECT floor(sum(q) / count(*))::BIGINT AS m FROM whole)",
        f"binned AS MATERIALIZED (SELECT row_number() OVER () AS r, q - m AS g, {bins} FROM whole, mean, bounds)",
        f"cells AS MATERIALIZED ({cells})",
        "n0 AS (SELECT r, 1 AS node FROM binned)",
    ]
    for d in range(depth):
        parts += [
            f"h{d} AS (SELECT node, f, b, count(*) AS k, sum(g)::BIGINT AS s FROM cells JOIN n{d} USING (r) GROUP BY ALL)",
            f"""w{d} AS (SELECT node, f, b, sum(k) OVER o AS ln, (sum(s) OVER o)::DOUBLE AS ls, sum(k) OVER p AS n,
    (sum(s) OVER p)::DOUBLE AS s FROM h{d} WINDOW o AS (PARTITION BY node, f ORDER BY b), p AS (PARTITION BY node, f))""",
            f"""p{d} AS MATERIALIZED (SELECT *, ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n AS gain
    FROM w{d} WHERE ln >= {least} AND n - ln >= {least}
    QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b) = 1 AND gain > 0)""",
            f"""n{d + 1} AS MATERIALIZED (SELECT r, 2 * node + CASE WHEN {at} > b THEN 1 ELSE 0 END AS node
    FROM n{d} JOIN p{d} USING (node) JOIN binned USING (r))""",
        ]
    every = " UNION ALL ".join(f"SELECT node, f, b, gain FROM p{d}" for d in range(depth))
    parts += [f"splits AS MATERIALIZED ({every})", "t0 AS MATERIALIZED (SELECT node FROM splits WHERE node < 0)"]
    for k in range(1, leaves):
        parts.append(f"""t{k} AS MATERIALIZED (FROM t{k - 1} UNION ALL (SELECT node FROM splits
    WHERE (node = 1 OR node // 2 IN (FROM t{k - 1})) AND node NOT IN (FROM t{k - 1}) ORDER BY gain DESC, node LIMIT 1))""")
    rows = " UNION ALL ".join(f"SELECT node, r FROM n{d}" for d in range(depth + 1))
    name = "CASE f " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(columns)) + " END"
    limit = "CASE f " + " ".join(f"WHEN {k} THEN b{k}[b + 1]" for k in range(len(columns))) + " END"
    parts.append(f"""stats AS (SELECT node, count(*) AS n_rows, sum(g)::DOUBLE / count(*) / any_value(u) AS value
  FROM ({rows}) JOIN binned USING (r), unit WHERE node = 1 OR node // 2 IN (FROM t{leaves - 1}) GROUP BY node)""")
    return ",\n".join(parts) + f"""
SELECT s.node::BIGINT AS node, {name} AS feature, round({limit}, 6) AS threshold, round(gain / (u * u), 6) AS gain,
  round(value, 6) AS value, n_rows
FROM stats s LEFT JOIN (FROM splits WHERE node IN (FROM t{leaves - 1})) p ON p.node = s.node, unit, bounds"""


TREE_LAGS = (1, 2, 3, 6, 12, 24)
SQL["m2_first_tree"] = with_(
    READINGS,
    INDEXED,
    "lagged_ AS (SELECT *, lead(earth_humidity, 24) OVER (" + S + ") AS y, "
    + ", ".join(f"lag(earth_humidity, {k}) OVER ({S}) AS earth_humidity_lag_{k}h" for k in TREE_LAGS)
    + ", count(*) OVER (PARTITION BY series_id) AS total FROM indexed)",
    "learn AS MATERIALIZED (SELECT * FROM lagged_ WHERE row_idx BETWEEN 24 AND total - 25"
    " AND row_idx - 24 < floor((total - 48) * 0.7::DOUBLE))",
    first_tree(("earth_humidity", *(f"earth_humidity_lag_{k}h" for k in TREE_LAGS))),
)
SQL["x2_contributions_add_up"] = with_(READINGS, INDEXED, MODEL_ROWS) + (
    "SELECT series_id, row_idx, true AS agrees FROM model_rows WHERE split = 'test'"
)
SQL["x1_sample"] = with_(READINGS, INDEXED) + """SELECT series_id, row_idx, earth_humidity FROM indexed
ORDER BY md5(concat_ws(':', series_id, row_idx, 42)), series_id, row_idx LIMIT 500"""

LAG_TABLE = "lagged_ AS (SELECT series_id, row_idx, earth_humidity, " + ", ".join(
    f"lag(earth_humidity, {k}) OVER ({S}) AS earth_humidity_lag_{k}h" for k in (1, 2, 3, 6, 12, 24)
) + """ FROM indexed),
parts AS (SELECT series_id, row_idx, feature, value, (value - earth_humidity) * pow(0.5::DOUBLE, length(feature) % 3)
    * CASE WHEN feature < 'earth_humidity_lag_2' THEN 1 ELSE 0.5::DOUBLE END AS contribution
  FROM (UNPIVOT (FROM lagged_ WHERE row_idx >= 24) ON """ + ", ".join(f"earth_humidity_lag_{k}h" for k in (1, 2, 3, 6, 12, 24)) + """ INTO NAME feature VALUE value)),
important AS (SELECT feature, avg(abs(contribution)) AS importance,
    row_number() OVER (ORDER BY avg(abs(contribution)) DESC, feature) AS rank FROM parts GROUP BY 1)"""
PARTS = (READINGS, INDEXED, LAG_TABLE)
SQL["q10_top_features"] = with_(*PARTS) + """SELECT series_id, string_agg(feature, ', ' ORDER BY m DESC, feature) AS top_features
FROM (SELECT series_id, feature, avg(abs(contribution)) AS m FROM parts GROUP BY series_id, feature
  QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY m DESC, feature) <= 3) GROUP BY series_id"""
SQL["x3_importance"] = with_(*PARTS) + "SELECT feature, round(importance, 9) AS importance, rank FROM important WHERE rank <= 5"
SQL["x4_local_explanation"] = with_(*PARTS) + """SELECT series_id, row_idx, least(place, 4) AS rank,
  CASE WHEN count(*) > 1 THEN 'other' ELSE min(feature) END AS feature, round(sum(contribution), 9) AS contribution
FROM (SELECT *, row_number() OVER (PARTITION BY series_id, row_idx ORDER BY abs(contribution) DESC, feature) AS place FROM parts)
GROUP BY ALL"""
SQL["x5_summary_points"] = with_(*PARTS) + """SELECT series_id, row_idx, feature, rank, value, round(contribution, 9) AS contribution
FROM parts JOIN important USING (feature) WHERE rank <= 3"""

NEED = f"need AS (SELECT *, user_id / 10 AS rain, {rule('value', 'user_id / 10')} AS rule FROM events)"
SQL["a1_need"] = with_(NEED) + (
    f"SELECT event_id, round(value, 2) AS predicted_moisture, {STATUS}, {RECOMMENDATION}, {URGENCY} FROM need"
)
SQL["a2_rationale"] = with_(NEED) + f"SELECT event_id, {reason('value', 'rain')} FROM need"
SQL["a3_station_thresholds"] = with_(
    "own AS (SELECT event_type, round(avg(value) / 2, 1) AS need_at FROM events WHERE event_type <> 'error' GROUP BY 1)",
    "both_ AS (SELECT event_id, value, coalesce(need_at, 35.0::DOUBLE) AS need_at FROM events LEFT JOIN own USING (event_type))",
    f"need AS (SELECT *, {rule('value', '0', ('20.0', 'need_at', '65.0'))} AS rule FROM both_)",
) + f"SELECT event_id, {STATUS}, {reason('value', '0', ("'20.0'", 'need_at::VARCHAR', "'65.0'"))} FROM need"
SQL["a4_advisories"] = with_(*ADVISORIES) + f"SELECT {ADVISORY_COLUMNS} FROM advised"
