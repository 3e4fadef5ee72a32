"""Unreadable sheets and p-values of very long series."""

import math

import pytest
from pyspark.sql import functions as F

from fieldsignal.functions.significance import p_value
from fieldsignal.sources import tables
from incomplete_beta import pearson_p


def test_unreadable_sheets_are_skipped(spark, tmp_path):
    folder = tmp_path / "plant 2024"
    folder.mkdir()
    (folder / "good.csv").write_text("timestamp,airTemperature,earthHumidity1\n2024-01-01 00:00:00,20,30\n")
    (folder / "broken.parquet").write_bytes(b"no parquet at all")
    found = tables.load_dataset(spark, str(folder), "2024").collect()
    assert [r["source_sheet"] for r in found] == ["good"]


@pytest.mark.parametrize("n", [10**6, 10**8, 10**10, 10**12])
def test_p_value_of_long_series(n):
    # With r = 1 / sqrt(n) the statistic is 1, and the law is normal but for terms of 1 / n.
    assert pearson_p(1 / math.sqrt(n), n) == pytest.approx(math.erfc(math.sqrt(0.5)), abs=2 / n + 1e-9)


def test_p_value_of_short_series():
    assert pearson_p(0.5, 3) == pytest.approx(2 / 3) and pearson_p(0.0, 20) == 1.0 and pearson_p(1.0, 20) == 0.0


def test_p_value_columns_equal_the_incomplete_beta_function(spark):
    rows = [(r, n) for n in (2, 3, 4, 5, 7, 10, 50, 1_000, 13_567, 10**6) for r in (0.0, 0.001, -0.02, 0.2, -0.7, 0.99, 1.0, None)]
    rows += [(10**-k, 10 ** (2 * k)) for k in (4, 5, 6)] + [(float("nan"), 10)]
    for x in spark.createDataFrame(rows, "r double, n long").withColumn("p", p_value(F.col("r"), F.col("n"))).collect():
        expected = pearson_p(x.r, x.n)
        assert x.p is None if expected is None else x.p == pytest.approx(expected, abs=2e-7)
