"""Row numbers, halo chunks and carried readings against whole-series results."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import by_row
from fieldsignal.operators import clean, hampel, index, profile
from fieldsignal.spec import SeriesSpec

SPEC = SeriesSpec(chunk_rows=64)


def gappy_series(spark, n=700, seed=5):
    """A hot series and two small ones, with gaps of up to 200 rows."""
    rng = np.random.default_rng(seed)
    frames = []
    for name, size in (("hot", n), ("small", 40), ("single", 1)):
        v = np.round(np.cumsum(rng.normal(size=size)), 2)
        v[rng.random(size) < 0.3] = np.nan
        if name == "hot":
            v[100:300] = np.nan
            v[:17] = np.nan
            v[-30:] = np.nan
        frames.append(pd.DataFrame({"series_id": name, "row_idx": range(size), "v": v}))
    pdf = pd.concat(frames, ignore_index=True)
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return pdf, df


def per_series(pdf, f):
    parts = [f(g.v).to_numpy() for _, g in pdf.sort_values(["series_id", "row_idx"]).groupby("series_id")]
    return np.concatenate(parts)


def assert_same(found, expected, tolerance=1e-9):
    found = np.array([np.nan if x is None else x for x in found], dtype=float)
    np.testing.assert_allclose(found, expected, rtol=0, atol=tolerance, equal_nan=True)


def test_row_index_equals_row_number(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("series_id"),
        F.expr("timestamp_ntz'1969-12-30 23:59:00' + make_dt_interval(0, 0, 0, cast((id * 7919) % 400000 as int))").alias("timestamp"),
        "id",
    )
    numbered = index.with_row_index(df, SPEC, tie_break=["id"], length="n")
    whole = Window.partitionBy("series_id").orderBy("timestamp", "id")
    size = F.count(F.lit(1)).over(Window.partitionBy("series_id"))
    checked = numbered.withColumns({"e": F.row_number().over(whole) - 1, "size": size})
    wrong = checked.where((F.col("e") != F.col("row_idx")) | (F.col("n") != F.col("size")))
    assert numbered.count() == 3000 and wrong.count() == 0


def test_chunked_frames_equal_whole_series(spark):
    pdf, df = gappy_series(spark)
    out = index.over_chunks(
        df, SPEC, 24, 24, lambda d, w: d.withColumns({"a": F.lag("v", 24).over(w), "b": F.lead("v", 24).over(w)})
    )
    assert_same(by_row(out, "a"), per_series(pdf, lambda v: v.shift(24)))
    assert_same(by_row(out, "b"), per_series(pdf, lambda v: v.shift(-24)))


def test_chunk_smaller_than_frame_is_refused(spark):
    _, df = gappy_series(spark)
    try:
        index.over_chunks(df, SeriesSpec(chunk_rows=8), 24, 0, lambda d, w: d)
    except ValueError:
        return
    raise AssertionError("a frame wider than a chunk must be refused")


def test_interpolate_and_fill_match_pandas(spark):
    pdf, df = gappy_series(spark)
    interpolated = clean.interpolate(df, SPEC, ["v"])
    limited = per_series(pdf, lambda v: v.interpolate("linear", limit=12, limit_direction="both"))
    assert_same(by_row(interpolated, "v"), limited)
    filled = per_series(pdf, lambda v: v.interpolate("linear", limit=12, limit_direction="both").bfill().ffill())
    assert_same(by_row(clean.impute(df, SPEC, ["v"]), "v"), filled)
    assert_same(by_row(clean.fill_edges(interpolated, SPEC, ["v"]), "v"), filled)


def test_small_interpolation_fixture(spark):
    n = None
    values = [n, n, 1.0, n, n, n, n, n, 7.0, n]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "series_id string, row_idx long, precipitation double")
    tiny = SeriesSpec(chunk_rows=3)
    got = by_row(clean.interpolate(df, tiny, ["precipitation"], 2), "precipitation")
    assert_same(got, [1, 1, 1, 2, 3, np.nan, 5, 6, 7, 7])
    assert_same(by_row(clean.impute(df, tiny, ["precipitation"], 2), "precipitation"), [1, 1, 1, 2, 3, 0, 5, 6, 7, 7])
    plain = df.withColumnRenamed("precipitation", "v")
    assert_same(by_row(clean.impute(plain, tiny, ["v"], 2), "v"), [1, 1, 1, 2, 3, 5, 5, 6, 7, 7])


def test_hampel_matches_pandas_across_chunks(spark):
    pdf, df = gappy_series(spark)
    out = hampel.hampel(df, SPEC, "v", keep_window=True)

    def med(v):
        return v.rolling(25, center=True, min_periods=1).median()

    assert_same(by_row(out, "_median"), per_series(pdf, med))
    assert_same(by_row(out, "_mad"), per_series(pdf, lambda v: med((v - med(v)).abs())))

    def cleaned(v):
        limit = (3.0 * 1.4826 * med((v - med(v)).abs())).replace(0, 1e-6)
        return v.where(~((v - med(v)).abs() > limit), med(v))

    assert_same(by_row(out, "v_hampel_cleaned"), per_series(pdf, cleaned))


def test_hampel_fixtures(spark):
    def run(values):
        df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "series_id string, row_idx long, v double")
        return by_row(hampel.hampel(df, SeriesSpec(chunk_rows=4), "v", 2), "v_is_outlier", "v_hampel_cleaned")

    got = run([10.0, 10.0, 11.0, 60.0, 11.0, 10.0, None, 10.0, 12.0])
    assert [f for f, _ in got] == [False] * 3 + [True] + [False] * 5
    assert [v for _, v in got] == [10, 10, 11, 11, 11, 10, None, 10, 12]
    flat = run([5.0, 5.0, 5.0, 5.1, 5.0, 5.0, 5.0])
    assert [f for f, _ in flat] == [False, False, False, True, False, False, False] and flat[3][1] == 5.0


def test_cadence_fixture(spark):
    hours = (0, 1, 2, 6, 7)
    df = spark.createDataFrame([("a", i, h) for i, h in enumerate(hours)] + [("b", 0, 0)], "series_id string, row_idx long, h int")
    df = df.withColumn("timestamp", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, h)"))
    got = {r.series_id: r for r in profile.cadence_report(df, SeriesSpec(chunk_rows=2)).collect()}
    assert (got["a"].median_seconds, got["a"].min_seconds, got["a"].max_seconds, got["a"].large_gaps) == (3600, 3600, 14400, 1)
    assert got["b"].median_seconds == 3600 and got["b"].large_gaps == 0


def test_exact_median_over_wide_values(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"series_id": ["a"] * 501 + ["b"] * 400, "x": rng.integers(0, 10**13, 901)})
    got = {r.series_id: r.median for r in profile.exact_median(profile.value_counts_of(spark.createDataFrame(pdf), SPEC, "x"), SPEC, "x").collect()}
    assert got == pdf.groupby("series_id").x.median().to_dict()


@pytest.mark.parametrize("groups", [(), (2,), (2, 2), (3, 2)])
def test_readings_travel_over_groups_of_chunks(spark, monkeypatch, groups):
    """Gaps longer than chunks, groups and groups of groups, against a walk over the series."""
    monkeypatch.setattr(index._carried, "__defaults__", (index.CHUNK, groups))
    spec = SeriesSpec(chunk_rows=3)
    readings = {"a": {0: 1.0, 40: 2.0, 41: 3.0}, "b": {59: 4.0}, "c": {}, "d": {k: float(k) for k in range(0, 60, 5)}}
    rows = [(s, k, known.get(k)) for s, known in readings.items() for k in range(60)]
    df = spark.createDataFrame(rows, "series_id string, row_idx long, v double").repartition(5)
    out = index.nearest_known(df, spec, ["v"])
    assert set(out.columns) == {"series_id", "row_idx", "v", "_pi_v", "_pv_v", "_ni_v", "_nv_v"}
    for r in out.collect():
        known = readings[r.series_id]
        before = max((k for k in known if k <= r.row_idx), default=None)
        after = min((k for k in known if k >= r.row_idx), default=None)
        assert (r._pi_v, r._pv_v, r._ni_v, r._nv_v) == (before, known.get(before), after, known.get(after))


def test_attach_equals_a_join_and_deals_a_hot_key_to_many_tasks(spark):
    rows = spark.range(3000).selectExpr("IF(id % 3 < 2, 'hot', concat('k', id % 7)) AS k", "id", "7 AS v")
    values = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("none", 4)], "k string, w int")
    out = index.attach(rows, values, ["k"], F.floor(F.col("id") / 100))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, rows.join(values, ["k"]).select(out.columns).collect()))
    left = index.attach(rows, values, ["k"], index.by_hash("id"), "left")
    assert left.count() == 3000 and left.where("w IS NULL").count() == rows.where("k NOT IN ('hot', 'k1', 'k2')").count()
