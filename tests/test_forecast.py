"""Features, split, metrics, boosting, attribution and advice."""

from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import by_row
from fieldsignal.functions import treeshap
from fieldsignal.operators import advise, attribute, evaluate, features, index, model, split
from fieldsignal.plans import flow
from fieldsignal.spec import SeriesSpec

SPEC = SeriesSpec(chunk_rows=64)


def hours(spark, n, stations=("a",)):
    return spark.range(n).select(
        F.explode(F.array(*[F.lit(s) for s in stations])).alias("series_id"),
        F.expr("timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0, cast(id as int))").alias("timestamp"),
        F.col("id").alias("row_idx"),
        (50 + 20 * F.sin(F.col("id") / 12) + F.pmod(F.col("id") * 37, F.lit(11))).alias("earth_humidity"),
        (F.pmod(F.col("id") * 7, F.lit(5)).cast("double")).alias("precipitation"),
    )


def test_rolling_and_lags_match_pandas(spark):
    df = hours(spark, 300)
    v = pd.Series(by_row(df, "earth_humidity"))
    rain = pd.Series(by_row(df, "precipitation"))

    def build(d, w):
        return features.with_rolling(
            d.withColumns(features.rain_sums(w) | features.target_lags(w) | features.lead_target(w)), w
        )

    out = index.over_chunks(df, SPEC, 24, 24, build)
    expected = {
        "earth_humidity_roll_mean_12h": v.rolling(12).mean(),
        "earth_humidity_roll_std_24h": v.rolling(24).std(),
        "earth_humidity_daily_range": v.rolling(24).max() - v.rolling(24).min(),
        "precip_accum_24h": rain.rolling(24, min_periods=1).sum(),
        "earth_humidity_lag_6h": v.shift(6),
        "target_24h_ahead": v.shift(-24),
    }
    for name, series in expected.items():
        got = np.array([np.nan if x is None else x for x in by_row(out, name)], dtype=float)
        np.testing.assert_allclose(got, series.to_numpy(), atol=1e-9, equal_nan=True, err_msg=name)


def test_feature_table_has_complete_rows_and_no_by_products(spark):
    df = hours(spark, 200).withColumn("earth_humidity_raw", F.lit(1.0)).withColumn("source_year", F.lit("2024"))
    out, names, label = features.build_features(df, SPEC)
    assert out.count() == 200 - 48 and label == "target_24h_ahead"
    assert not {"earth_humidity_raw", "source_year", "row_idx", label} & set(names)
    assert {"hour_sin", "is_weekend", "precip_accum_6h", "earth_humidity"} <= set(names)
    first = out.orderBy("row_idx").first()
    assert first.row_idx == 24 and first.day_of_week == 5 and first.is_weekend == 1


@pytest.mark.parametrize("n,train,val", [(1, 0, 0), (3, 2, 2), (7, 4, 5), (10, 7, 8), (100, 70, 85), (1000, 700, 850)])
def test_split_bounds(spark, n, train, val):
    counts = dict(split.chronological_split(hours(spark, n), SPEC).groupBy("split").count().collect())
    assert [counts.get(k, 0) for k in ("train", "val", "test")] == [train, val - train, n - val]


def test_pooled_split_cuts_all_series_at_the_same_times(spark):
    late = hours(spark, 100, ("a", "b")).where("series_id = 'a' OR row_idx >= 60")
    late = late.union(late.limit(1).withColumn("timestamp", F.lit(None).cast("timestamp_ntz")))
    out = split.pooled_split(late, SPEC)
    spans = {r.split: r for r in out.groupBy("split").agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"), F.count("*").alias("n")).collect()}
    assert spans["train"].hi < spans["val"].lo and spans["val"].hi < spans["test"].lo
    assert [spans[k].n for k in ("train", "val", "test", None)] == [80, 30, 30, 1]
    assert split.pooled_split(late.limit(0), SPEC).count() == 0


def test_split_is_chronological(spark):
    out = split.chronological_split(hours(spark, 50, ("a", "b")), SPEC)
    spans = {(r.series_id, r.split): r for r in out.groupBy("series_id", "split").agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).collect()}
    for s in "ab":
        assert spans[s, "train"].hi < spans[s, "val"].lo and spans[s, "val"].hi < spans[s, "test"].lo


def test_metrics_fixture(spark):
    df = spark.createDataFrame([("t", y, p) for y, p in ((0.0, 1.0), (10.0, 12.0), (20.0, 18.0), (40.0, 40.0))], "split string, y double, p double")
    got = evaluate.evaluate(df, ["split"], "y", "p").first()
    assert (got.mae, got.rmse, got.r2, got.mape_pct) == (1.25, 1.5, 0.9897, 10.0)
    zero = evaluate.evaluate(df.where("y = 0"), ["split"], "y", "p").first()
    assert zero.mape_pct == 0.0 and zero.r2 is None


def test_histogram_covers_all_rows(spark):
    df = spark.range(1000).select(F.lit("t").alias("split"), (F.sqrt("id") * 3).alias("residual"))
    bins = evaluate.residual_histogram(df, ["split"]).toPandas()
    expected, _ = np.histogram(np.sqrt(np.arange(1000)) * 3, bins=40)
    got = bins.set_index("bin").n_rows.reindex(range(40), fill_value=0)
    assert list(got) == list(expected)
    width = np.sqrt(999) * 3 / 40
    assert (bins.density * width).sum() == pytest.approx(1)


@pytest.mark.parametrize(
    "errors,patience,kept", [([5, 4, 3], 2, 3), ([5, 4, 4.5, 4.6, 1], 2, 2), ([5, 4, 4.5, 3], 2, 4), ([1, 2, 3], 5, 1)]
)
def test_patience(errors, patience, kept):
    assert model.stop_round(errors, patience) == kept


def brute_force(nodes, x):
    """Shapley values of one tree by enumerating every feature subset."""

    def value(node, known):
        prediction, left, right, feature, threshold, rows = nodes[node]
        if left < 0:
            return prediction
        if feature in known:
            return value(left if x[feature] <= threshold else right, known)
        return sum(value(c, known) * nodes[c][5] / rows for c in (left, right))

    m = len(x)
    out = np.zeros(m)
    for f in range(m):
        others = [j for j in range(m) if j != f]
        for size in range(m):
            for chosen in combinations(others, size):
                weight = factorial(size) * factorial(m - 1 - size) / factorial(m)
                out[f] += weight * (value(0, {*chosen, f}) - value(0, set(chosen)))
    return value(0, set()), out


def test_contributions_match_brute_force():
    # id -> (prediction, left, right, feature, threshold, rows); feature 0 is split twice.
    nodes = {
        0: (0.0, 1, 2, 0, 0.5, 100.0), 1: (0.0, 3, 4, 1, 0.3, 60.0), 2: (0.0, 5, 6, 0, 0.8, 40.0),
        3: (1.0, -1, -1, -1, None, 25.0), 4: (-2.0, -1, -1, -1, None, 35.0), 5: (4.0, -1, -1, -1, None, 10.0),
        6: (0.0, 7, 8, 2, 0.5, 30.0), 7: (7.0, -1, -1, -1, None, 12.0), 8: (3.0, -1, -1, -1, None, 18.0),
    }
    leaves = treeshap.leaves_of(nodes, 1.0)
    rows = np.random.default_rng(3).random((20, 4))
    got = treeshap.contributions(rows, leaves)
    for x, mine in zip(rows, got):
        base, expected = brute_force(nodes, x)
        np.testing.assert_allclose(mine, expected, atol=1e-12)
        assert treeshap.base_value(leaves) == pytest.approx(base)


def test_model_predicts_and_contributions_add_up(spark, tmp_path):
    featured, names, label = features.build_features(hours(spark, 400, ("a", "b")), SPEC)
    splits = split.chronological_split(featured, SPEC).cache()
    params = model.BoostingParams(rounds=4, depth=3, patience=4, step=0.3)
    fitted = model.train(splits, names, label, params)
    assert fitted.features == names and 1 <= fitted.best_rounds <= 4 == len(fitted.validation_mse)
    assert fitted.train_mse[-1] < fitted.train_mse[0]
    test = splits.where("split = 'test'")
    scored = model.predict(fitted.model, test)
    parts = attribute.contributions(test, fitted, SPEC)
    total = parts.groupBy("series_id", "row_idx").agg((F.sum("contribution") + F.first("base_value")).alias("total"))
    joined = total.join(scored, ["series_id", "row_idx"])
    assert joined.count() == test.count()
    assert joined.agg(F.max(F.abs(F.col("total") - F.col("prediction")))).first()[0] < 1e-6
    ranked = attribute.importance(parts, 3).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3] and ranked[0].importance >= ranked[2].importance
    local = attribute.explain_row(parts.where("series_id = 'a'"), SPEC, F.lit(True), 5)
    sums = local.groupBy("row_idx").agg(F.sum("contribution").alias("s"), F.count("*").alias("n"))
    assert sums.where("n <> 5").count() == 0
    from fieldsignal.sources import sinks

    sinks.save_model(fitted.model, spark, str(tmp_path / "model"))
    again = model.predict(sinks.load_model(spark, str(tmp_path / "model")), test)
    assert again.select("prediction").exceptAll(scored.select("prediction")).count() == 0


def test_sample_is_repeatable(spark):
    df = hours(spark, 300)
    a, b = (attribute.sample_rows(x, SPEC, 50) for x in (df, df.repartition(7)))
    assert a.count() == 50 and a.exceptAll(b).count() == 0
    assert attribute.sample_rows(df, SPEC, 1000).count() == 300


RULES = [
    (19.99, 0.0, "CRITICAL DEFICIT"), (20.0, 0.0, "MOISTURE DEFICIT"), (34.99, 0.0, "MOISTURE DEFICIT"),
    (34.99, 5.0, "DEFICIT (RAIN EXPECTED)"), (34.99, 4.99, "MOISTURE DEFICIT"), (15.0, 50.0, "CRITICAL DEFICIT"),
    (35.0, 0.0, "OPTIMAL MOISTURE"), (65.0, 0.0, "OPTIMAL MOISTURE"), (65.01, 0.0, "SATURATION / EXCESS"),
    (15.2, 0.0, "CRITICAL DEFICIT"), (28.4, 0.0, "MOISTURE DEFICIT"), (45.0, 0.0, "OPTIMAL MOISTURE"),
    (72.1, 0.0, "SATURATION / EXCESS"), (None, 0.0, None),
]


def test_advisory_rules(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(RULES)], "i int, m double, rain double, expected string")
    out = df.select("i", "expected", advise.irrigation_need(F.col("m"), F.col("rain")).alias("n")).orderBy("i").collect()
    assert [r.n.status for r in out] == [r.expected for r in out]
    assert out[1].n.agronomic_rationale == "Forecasted moisture (20.0%) falls below optimal threshold (35.0%)."
    assert out[0].n.urgency == "High" and out[0].n.predicted_moisture == 19.99
    changed = advise.thresholds_as_columns({"critical_dry": 30})
    low = df.where("i = 10").select(advise.irrigation_need(F.col("m"), thresholds=changed).alias("n")).first().n
    assert low.status == "CRITICAL DEFICIT" and low.agronomic_rationale.endswith("(30.0%).")


def test_whole_flow(spark, tmp_path):
    """Two stations with faults, through every stage, saved and read back."""
    raw = hours(spark, 260, ("a", "b")).withColumn(
        "earth_humidity",
        F.when(F.col("row_idx") == 60, -999.0).when(F.col("row_idx") == 90, 99.0).otherwise(F.col("earth_humidity")),
    )
    sheets = raw.select(
        F.col("series_id").alias("station_id"), F.col("timestamp").cast("string").alias("communicate_at"),
        F.col("earth_humidity").cast("string").alias("earth_humidity"), "precipitation",
        F.lit("soil").alias("source_sheet"), F.lit("2024").alias("source_year"),
    )
    spec = SeriesSpec(series=("station_id",), chunk_rows=512)
    config = flow.FlowConfig(max_imfs=2, trials=3, boosting=model.BoostingParams(rounds=3, depth=3, patience=2))
    result = flow.run([sheets], spec, config)
    assert result.cleaned.where("earth_humidity is null").count() == 0
    repaired = result.flagged.where("row_idx = 90").collect()
    assert all(r.earth_humidity_is_outlier and r.earth_humidity < 99 for r in repaired)
    assert {r.split for r in result.metrics.collect()} == {"train", "val", "test"}
    assert {"imf_1", "imf_residue", "earth_humidity_reconstructed_lag_24h"} <= set(result.fitted.features)
    summary = result.summary.collect()
    assert len(summary) == 2 and all(r.labels == "2024" and r.n_rows == 260 for r in summary)
    assert all(set(r.top_features.split(", ")) < set(result.fitted.features) for r in summary)
    flow.save(result, str(tmp_path / "out"), spec)
    assert spark.read.parquet(str(tmp_path / "out/processed/cleaned")).count() == 520
