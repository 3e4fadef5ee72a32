"""Regression metrics and residual diagnostics, per series and split or over all series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsignal.operators.index import attach, by_hash

# Fixed value: actual values this close to zero have no percentage error.
ZERO_ACTUAL = 1e-4


def _error(actual: str, predicted: str) -> Column:
    return F.col(actual) - F.col(predicted)


def mape(actual: str, predicted: str) -> Column:
    """Mean absolute percentage error over clearly non-zero actual values, else 0."""
    relative = F.when(F.abs(F.col(actual)) > ZERO_ACTUAL, F.abs(_error(actual, predicted) / F.col(actual)))
    return F.round(F.coalesce(F.avg(relative) * 100, F.lit(0.0)), 2)


def evaluate(df: DataFrame, groups: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE, R2 and MAPE of every group in one aggregation.

    R2 of a constant actual column is undefined here and comes out NULL.
    """
    error = _error(actual, predicted)
    spread = F.count(F.lit(1)) * F.var_pop(actual)
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg(F.abs(error)), 4).alias("mae"),
        F.round(F.sqrt(F.avg(error * error)), 4).alias("rmse"),
        F.round(1 - F.sum(error * error) / F.when(spread > 0, spread), 4).alias("r2"),
        mape(actual, predicted).alias("mape_pct"),
    )


def residuals(df: DataFrame, keep: Sequence[str], actual: str, predicted: str) -> DataFrame:
    return df.select(
        *keep, F.col(predicted).alias("predicted"), _error(actual, predicted).alias("residual")
    )


def residual_moments(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    return df.groupBy(*groups).agg(
        F.avg("residual").alias("residual_mean"), F.stddev_pop("residual").alias("residual_std")
    )


def residual_histogram(df: DataFrame, groups: Sequence[str], bins: int = 40) -> DataFrame:
    """Equal-width bins from the smallest to the largest residual, with density.

    Empty bins have no row; the largest residual belongs to the last bin. Residuals are counted per
    distinct value first, so that a common one is one row when it meets the bounds of its group.
    """
    counts = df.where(F.col("residual").isNotNull()).groupBy(*groups, "residual").agg(F.count(F.lit(1)).alias("_c"))
    bounds = counts.groupBy(*groups).agg(
        F.min("residual").alias("_low"), F.max("residual").alias("_high"), F.sum("_c").alias("_n")
    )
    width = (F.col("_high") - F.col("_low")) / bins
    place = F.floor((F.col("residual") - F.col("_low")) / (F.col("_high") - F.col("_low")) * bins)
    return (
        attach(counts, bounds.where("_high > _low"), groups, by_hash("residual"))
        .withColumn("bin", F.least(place, F.lit(bins - 1)).cast("long"))
        .groupBy(*groups, "bin", "_low", "_high", "_n")
        .agg(F.sum("_c").alias("n_rows"))
        .select(
            *groups,
            "bin",
            "n_rows",
            (F.col("_low") + F.col("bin") * width).alias("bin_start"),
            (F.col("n_rows") / (F.col("_n") * width)).alias("density"),
        )
    )
