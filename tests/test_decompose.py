"""Extrema, sifting and decomposition: blocks of a long series against the whole one."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldsignal.functions import sifting
from fieldsignal.operators import decompose, reconstruct
from fieldsignal.spec import SeriesSpec
from incomplete_beta import pearson_p


@pytest.fixture(scope="module")
def signals(spark):
    """A walk with plateaus, a short walk, and a series that is mostly flat across blocks."""
    rng = np.random.default_rng(0)
    frames = []
    for name, size, digits in (("a", 150, 1), ("b", 40, 1), ("c", 60, 0)):
        v = np.cumsum(rng.normal(size=size)).round(digits)
        if name == "c":
            v[10:50] = 3.0
        frames.append(pd.DataFrame({"series_id": name, "row_idx": range(size), "v": v}))
    pdf = pd.concat(frames, ignore_index=True)
    return pdf, spark.createDataFrame(pdf)


def test_extrema_fixtures():
    def points(values):
        peaks, troughs = sifting.turning_points(np.array(values, dtype=float))
        return list(peaks), list(troughs)

    assert points([0, 2, 2, 2, 0]) == ([2], [])
    assert points([0, 2, 2, 0]) == ([1], [])
    assert points([2, 2, 0, 1, 1]) == ([], [2])
    assert points([1, 1, 1]) == ([], [])


@pytest.mark.parametrize("block_rows", [8, 512])
def test_one_sift_is_exact_over_blocks(spark, signals, block_rows):
    pdf, df = signals
    spec = SeriesSpec(block_rows=block_rows)
    found = decompose.extrema(df, spec, "v").toPandas()
    curves = decompose.envelopes(df, spec, "v").toPandas().sort_values(["series_id", "row_idx"])
    sifted = decompose.sift_once(df, spec, "v").toPandas().sort_values(["series_id", "row_idx"])
    for name, g in pdf.groupby("series_id"):
        h = g.v.to_numpy()
        peaks, troughs = sifting.turning_points(h)
        for kind, expected in (("peak", peaks), ("trough", troughs)):
            got = found[(found.series_id == name) & (found.kind == kind)].row_idx
            assert sorted(got) == list(expected)
        up, low = (sifting.envelope(h, 0, h.size, p) for p in (peaks, troughs))
        mine = curves[curves.series_id == name]
        np.testing.assert_allclose(mine.upper, up, atol=1e-12)
        np.testing.assert_allclose(mine.lower, low, atol=1e-12)
        expected = h - (up + low) / 2 if min(peaks.size, troughs.size) >= 3 else h
        np.testing.assert_allclose(sifted[sifted.series_id == name].sifted, expected, atol=1e-12)


def test_split_series_give_the_same_modes(spark, signals):
    _, df = signals
    whole = decompose.emd(df, SeriesSpec(block_rows=512), "v", 2).toPandas()
    split = decompose.emd(df, SeriesSpec(block_rows=64), "v", 2).toPandas()
    both = whole.merge(split, on=["series_id", "row_idx", "component"], how="outer")
    assert len(both) == len(whole) == len(split)
    np.testing.assert_allclose(both.value_x, both.value_y, atol=1e-12)


def test_window_proves_what_the_whole_series_gives():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=400), np.full(30, 2.0), np.cumsum(rng.normal(size=300)).round(1)])
    whole, proven = sifting.first_mode(x), 0
    for start in range(0, 730, 45):
        for stop in (start + 60, start + 200, start + 600, 730):
            part = x[start:stop]
            made = sifting.window_mode(part, start, x.size)
            if made is not None:
                h, low, high = made
                np.testing.assert_allclose(h[low:high], whole[start + low : start + high], atol=1e-12)
                proven += high - low
    assert proven > 5_000
    h, low, high = sifting.window_mode(x, 0, x.size)
    assert (low, high) == (0, x.size) and np.array_equal(h, whole)
    assert sifting.window_mode(np.arange(50.0), 10, 500) is None


@pytest.mark.parametrize("first_halo, most_halo", [(8, 1000), (8, 16), (64, 64)])
def test_windows_that_fail_are_looked_at_again(spark, signals, monkeypatch, first_halo, most_halo):
    """Halos that suffice at once, after growing, or never for some series: the modes are the same."""
    monkeypatch.setattr(decompose, "FIRST_HALO", first_halo)
    monkeypatch.setattr(decompose, "MOST_HALO", most_halo)
    _, df = signals
    whole = decompose.emd(df, SeriesSpec(block_rows=512), "v", 3).toPandas()
    split = decompose.emd(df, SeriesSpec(block_rows=16), "v", 3).toPandas()
    both = whole.merge(split, on=["series_id", "row_idx", "component"], how="outer")
    assert len(both) == len(whole) == len(split)
    np.testing.assert_allclose(both.value_x, both.value_y, atol=1e-12)


def test_only_the_blocks_that_failed_are_looked_at_again(spark, monkeypatch):
    """Noise, whose short halo suffices, beside a slow wave, whose does not."""
    monkeypatch.setattr(decompose, "FIRST_HALO", 32)
    x = np.concatenate([np.random.default_rng(8).normal(size=300), 3 * np.sin(np.arange(300) / 9)])
    df = spark.createDataFrame(pd.DataFrame({"series_id": "s", "row_idx": range(x.size), "v": x}))
    modes = decompose.emd(df, SeriesSpec(block_rows=16), "v", 2).toPandas().sort_values("row_idx")
    assert len(modes) == 2 * x.size
    np.testing.assert_allclose(modes[modes.component == 1].value, sifting.first_mode(x), atol=1e-12)


def test_ensemble_over_short_blocks_is_the_same(spark, signals):
    _, df = signals
    spec, short = SeriesSpec(block_rows=512), SeriesSpec(block_rows=32)
    a, b = (decompose.ceemdan(df, s, "v", max_imfs=2, trials=3).toPandas() for s in (spec, short))
    both = a.merge(b, on=["series_id", "row_idx", "component"], how="outer")
    assert len(both) == len(a) == len(b)
    np.testing.assert_allclose(both.value_x, both.value_y, atol=1e-9)


def test_ensemble_modes_add_up_and_repeat(spark, signals):
    pdf, df = signals
    spec = SeriesSpec(block_rows=512)
    modes = decompose.ceemdan(df, spec, "v", max_imfs=2, trials=4)
    again = decompose.ceemdan(df.repartition(5), spec, "v", max_imfs=2, trials=4)
    a, b = (m.toPandas().sort_values(["series_id", "row_idx", "component"]).reset_index(drop=True) for m in (modes, again))
    pd.testing.assert_frame_equal(a, b)
    total = a.groupby(["series_id", "row_idx"]).value.sum().reset_index().merge(pdf)
    np.testing.assert_allclose(total.value, total.v, atol=1e-8)
    assert set(a.component) == {0, 1, 2, 3}
    wide = decompose.attach_modes(df, modes, spec, 3)
    assert wide.columns[-4:] == ["imf_1", "imf_2", "imf_3", "imf_residue"] and wide.count() == len(pdf)


def test_noise_is_standard_normal_and_positional():
    w = sifting.white_noise(42, 7, 3, 0, 20_000)
    assert abs(w.mean()) < 0.03 and abs(w.std() - 1) < 0.03
    np.testing.assert_array_equal(w[500:700], sifting.white_noise(42, 7, 3, 500, 200))
    assert abs(np.corrcoef(w, sifting.white_noise(42, 7, 4, 0, 20_000))[0, 1]) < 0.03


# Component, energy share, correlation, p-value of the published report on 13,567 rows.
REPORT = [
    (1, 0.02, 0.0146, 0.089349), (2, 0.02, 0.0091, 0.28928), (3, 0.01, 0.0254, 0.003112), (4, 0.02, 0.0384, 8e-06),
    (5, 0.04, 0.0386, 7e-06), (6, 0.1, 0.0313, 0.000268), (7, 0.75, 0.2726, 0.0), (8, 0.88, 0.2502, 0.0),
    (0, 98.15, 0.9163, 0.0),
]


def test_p_values_of_the_report():
    for _, _, r, p in REPORT:
        around = [pearson_p(abs(r) + d, 13_567) for d in (5e-5, -5e-5)]
        assert around[0] - 1e-6 <= p <= around[1] + 1e-6
    assert pearson_p(0.0, 10) == 1.0 and pearson_p(float("nan"), 10) is None and pearson_p(0.5, 2) is None


def test_selection_of_the_report(spark):
    df = spark.createDataFrame(REPORT, "component int, energy_pct double, pearson_r double, p_value double")
    chosen = reconstruct.select_modes(df).where("selected").select("component").collect()
    assert {r.component for r in chosen} == {7, 8, 0}


def test_statistics_and_reconstruction(spark, signals):
    pdf, df = signals
    spec = SeriesSpec(block_rows=512)
    modes = decompose.emd(df, spec, "v", 4)
    wide = modes.toPandas().pivot_table(index=["series_id", "row_idx"], columns="component", values="value").reset_index()
    stats = reconstruct.select_modes(reconstruct.mode_statistics(modes, df, spec, "v"))
    got = {(r.series_id, r.component): r for r in stats.collect()}
    g = wide[wide.series_id == "a"].merge(pdf)
    x = g[1].to_numpy()
    row = got[("a", 1)]
    assert row.variance == pytest.approx(x.var(), abs=1e-4) and row.energy == pytest.approx((x * x).sum(), abs=1e-2)
    assert row.pearson_r == pytest.approx(np.corrcoef(x, g.v)[0, 1], abs=1e-4) and row.component_name == "IMF 1"
    rebuilt = reconstruct.attach_reconstruction(df, modes, stats, spec, "v")
    gap = rebuilt.select(F.max(F.abs(F.col("v_reconstructed") + F.col("v_extracted_noise") - F.col("v")))).first()[0]
    assert gap < 1e-9


@pytest.mark.parametrize("most_halo", [64, 65_536])
def test_ensemble_by_windows_equals_the_tables_of_all_trials(spark, signals, monkeypatch, most_halo):
    """Windows much shorter than the series, whose halos suffice, after growing or never; all noise modes take part."""
    _, df = signals
    rng = np.random.default_rng(6)
    long = spark.createDataFrame(pd.DataFrame({"series_id": "n", "row_idx": range(900), "v": rng.normal(size=900)}))
    spec = SeriesSpec(block_rows=16)
    blocks = decompose.materialize(decompose.to_blocks(df.unionByName(long), spec, "v"))
    monkeypatch.setattr(decompose, "ENSEMBLE_HALO", 16)
    monkeypatch.setattr(decompose, "MOST_HALO", most_halo)
    expected = decompose._ensemble_by_tables(blocks, spec, 2, 2, 0.2, 42).toPandas()
    made = decompose._ensemble_modes(blocks, spec, 2, 2, 0.2, 42).toPandas()
    both = expected.merge(made, on=["series_id", "chunk", "start", "size"], how="outer")
    assert len(both) == len(expected) == len(made)
    np.testing.assert_allclose(np.concatenate(both.values_x), np.concatenate(both.values_y), atol=1e-12)


def test_ensemble_writes_no_table_longer_than_the_signal(spark, signals, monkeypatch):
    """Before, the noise and its modes were written for every trial."""
    pdf, df = signals
    written, plain = [], decompose.materialize
    monkeypatch.setattr(decompose, "materialize", lambda made: written.append(plain(made)) or written[-1])
    decompose.ceemdan(df, SeriesSpec(block_rows=32), "v", max_imfs=2, trials=5).count()
    samples = [t.agg(F.sum(F.size("values"))).first()[0] or 0 for t in written if "values" in t.columns]
    assert samples and max(samples) <= len(pdf)


def test_blocks_are_handed_on_before_a_task_is_done(spark, monkeypatch):
    """A batch of long blocks is not held as a whole with all its modes."""
    x = np.random.default_rng(3).normal(size=4000)
    df = spark.createDataFrame(pd.DataFrame({"series_id": "s", "row_idx": range(x.size), "v": x})).coalesce(1)
    blocks = decompose.to_blocks(df, SeriesSpec(block_rows=100), "v").coalesce(1)
    monkeypatch.setattr(decompose, "HELD_SAMPLES", 250)
    twice = decompose._flat_map_blocks(blocks, [decompose.VALUES], lambda row: [{"values": row["values"]}] * 2)
    assert sorted(r.chunk for r in twice.collect()) == sorted([*range(40)] * 2)
