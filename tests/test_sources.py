"""Names, discovery, sheets, sinks."""

import pytest
from pyspark.sql import functions as F

from fieldsignal.operators import clean
from fieldsignal.sources import naming, sinks, tables
from fieldsignal.spec import SeriesSpec

NAMES = {
    "airTemperature": "air_temperature", "earthHumidity1": "earth_humidity1", " Dew Point ": "dew_point",
    "V.Batt": "v_batt", "solar-panel--voltage": "solar_panel_voltage", "__ID__": "id", "airTEMP": "air_temp",
}


def test_snake_case_as_name_and_as_column(spark):
    assert {n: naming.snake_case(n) for n in NAMES} == NAMES
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    assert dict(df.select("n", naming.snake_case_column(F.col("n"))).collect()) == NAMES


def test_canonical_names_and_collisions(spark):
    df = spark.createDataFrame([("t1", 1.0, None, 3.0), ("t2", None, 5.0, 4.0)], "timestamp string, humidity double, earthHumidity1 double, `atmospheric pressure` double")
    out = naming.to_canonical(df)
    assert out.columns == ["communicate_at", "earth_humidity", "atmospheric_pressure"]
    assert [r.earth_humidity for r in out.orderBy("communicate_at").collect()] == [1.0, 5.0]
    both = spark.createDataFrame([(1.0, 2.0)], "humidity double, earth_humidity double")
    assert naming.to_canonical(both).first().earth_humidity == 2.0


def test_environmental_tables():
    assert naming.looks_environmental(["Date", "Time", "airTemperature"])
    assert not naming.looks_environmental(["Date", "Soil"])
    assert not naming.looks_environmental(["Date", "Name", "Owner"])
    assert not naming.looks_environmental(["Key", "airTemperature", "Owner"])


@pytest.fixture
def workbooks(spark, tmp_path):
    """Two yearly datasets with a soil, a weather and an unrelated sheet each."""
    for year in (2024, 2025):
        folder = tmp_path / "data" / "raw" / f"station_{year}"
        folder.mkdir(parents=True)
        (folder / "soil.csv").write_text(
            "Station ID,communicateAt,earthHumidity1\n"
            f"a,{year}-01-01 00:00:00,10\na,{year}-01-01 01:00:00,bad\na,nonsense,11\n"
        )
        (folder / "weather.csv").write_text(
            f"Station ID,communicateAt,airTemperature\na,{year}-01-01 00:00:00,21.5\n"
        )
        (folder / "notes.csv").write_text("who,what,why\nx,y,z\n")
    (tmp_path / "abnormal_set.csv").write_text(
        "timestamp,temperature,air humidity\n2024-01-01 00:00:00,20,55\n2024-01-01 01:00:00,-999,56\n"
    )
    return str(tmp_path)


def test_pair_is_found_stacked_and_merged(spark, workbooks):
    first, second = tables.load_pair(spark, workbooks)
    assert first.count() == 4 and {r.source_sheet for r in first.collect()} == {"soil", "weather"}
    spec = SeriesSpec(series=("station_id",))
    rows = clean.combine_and_clean(first, second, spec).orderBy("row_idx").collect()
    assert [r.row_idx for r in rows] == [0, 1, 2, 3]
    assert rows[0].earth_humidity == 10 and rows[0].air_temperature == 21.5 and rows[0].source_year == "2024"
    assert rows[1].earth_humidity == 10


def test_missing_dataset_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.load_pair(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        tables.load_abnormal(spark, base=str(tmp_path))


def test_unrelated_tables_only_is_an_error(spark):
    df = spark.createDataFrame([("x", "y", "z")], "who string, what string, why string")
    with pytest.raises(ValueError):
        tables.stack_tables({"notes": df}, "2024")


def test_abnormal_table_mirrors_air_channels(spark, workbooks):
    loaded = tables.load_abnormal(spark, base=workbooks)
    row = loaded.orderBy("communicate_at").first()
    assert (row.earth_humidity, row.earth_temperature) == (row.air_humidity, row.air_temperature) == ("55", "20")
    assert row.source_sheet == "abnormal_set" and row.source_year == tables.ABNORMAL_LABEL


def test_series_sink_round_trip(spark, tmp_path):
    df = spark.range(100).select(
        F.lit("a").alias("series_id"),
        F.expr("timestamp_ntz'2024-01-20 00:00:00' + make_dt_interval(cast(id as int))").alias("timestamp"),
        F.col("id").cast("double").alias("v"),
    )
    path = str(tmp_path / "out")
    sinks.write_series(df, path, SeriesSpec())
    back = spark.read.parquet(path)
    assert back.drop("month").exceptAll(df).count() == 0 and back.count() == 100
    assert back.select("month").distinct().count() == 4


def test_timestamp_cases(spark):
    df = spark.createDataFrame(
        [("2024-01-02 03:04:05", None, None), (None, "2024-01-03 00:00:00", " 06:07:08"), ("junk", None, None)],
        "communicate_at string, date string, time string",
    )
    got = [str(r.timestamp) for r in clean.unify_timestamp(df).collect()]
    assert got == ["2024-01-02 03:04:05", "2024-01-03 06:07:08", "None"]
    strict = [str(r.timestamp) for r in clean.unify_timestamp(df, strict=True).collect()]
    assert strict == ["2024-01-02 03:04:05", "None", "None"]
    with pytest.raises(ValueError):
        clean.unify_timestamp(df.drop("communicate_at", "date"))


def test_sentinels_and_bounds(spark):
    df = spark.createDataFrame(
        [(-999.0, 999.0), (0.0, 1000.0), (100.0, 699.9), (100.1, 1150.0), (999.0, None)],
        "earth_humidity double, air_pressure double",
    )
    got = [tuple(r) for r in clean.sanitize(df).collect()]
    assert got == [(None, None), (0.0, 1000.0), (100.0, None), (None, 1150.0), (None, None)]


def test_deduplicate_merges_rows(spark):
    df = spark.createDataFrame(
        [("x", 1, 1.0, None, None, 1), ("x", 1, None, 5.0, "x", 2), ("x", 1, None, None, "a", 3), ("x", 2, 3.0, 6.0, "y", 4)],
        "series_id string, timestamp int, a double, b double, s string, n int",
    )
    got = [tuple(r) for r in clean.deduplicate(df, SeriesSpec(), "n").orderBy("timestamp").collect()]
    assert got == [("x", 1, 1.0, 5.0, "x"), ("x", 2, 3.0, 6.0, "y")]


def test_many_sheets_are_one_scan(spark, tmp_path):
    heads = ["Station ID,dateTime,airTemperature", "dateTime,soil-moisture,earthHumidity1,id", "datetime;x"]
    sizes = {}
    for count in (6, 200):
        folder = tmp_path / f"set {count} [2024]"
        folder.mkdir()
        for k in range(count):
            rows = [heads[k % 2], f"s{k},2024-01-01,{k}" if k % 2 == 0 else f"2024-01-02,,{k},s{k}"]
            (folder / f"sheet {k}.csv").write_text("\n".join(rows) + "\n")
        (folder / "empty.csv").write_text(heads[0] + ",battery\n")
        (folder / "none.csv").write_text("")
        (folder / "other.csv").write_text(heads[2] + "\n1;2\n")
        stacked = tables.load_dataset(spark, str(folder), "2024")
        found = {r.source_sheet: r for r in stacked.collect()}
        assert len(found) == count and "battery" not in stacked.columns
        for k in range(count):
            row = found[f"sheet {k}"]
            value = row.air_temperature if k % 2 == 0 else row.earth_humidity
            assert (row.station_id, value, row.source_year) == (f"s{k}", str(k), "2024")
        sizes[count] = len(stacked._jdf.queryExecution().optimizedPlan().treeString().splitlines())
    assert sizes[6] == sizes[200]


def test_header_names_of_repeated_and_blank_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,,a,b\n1,2,3,4\n")
    assert tables._header_names("A,,a,b") == tables.read_table(spark, str(tmp_path / "a.csv")).columns
