"""Chronological train, validation and test parts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldsignal.operators.index import with_row_index
from fieldsignal.spec import SeriesSpec


def chronological_split(
    df: DataFrame, spec: SeriesSpec, train_ratio: float = 0.70, val_ratio: float = 0.15
) -> DataFrame:
    """Renumber the rows of each series and add ``split``: the earliest rows train, the
    next ones validate, the latest test; bounds are truncated products."""
    numbered = with_row_index(df.drop(spec.index), spec, length="_n")
    # The sum of the ratios is taken first, as a double, so that bounds agree to the row.
    train_end = F.floor(F.col("_n") * F.lit(train_ratio))
    val_end = F.floor(F.col("_n") * F.lit(train_ratio + val_ratio))
    part = (
        F.when(F.col(spec.index) < train_end, "train")
        .when(F.col(spec.index) < val_end, "val")
        .otherwise("test")
    )
    return numbered.withColumn("split", part).drop("_n")


def pooled_split(df: DataFrame, spec: SeriesSpec, train_ratio: float = 0.70, val_ratio: float = 0.15) -> DataFrame:
    """Add ``split`` by time over all series together, so that no row learns from another series' future.

    The distinct times of all series are numbered by calendar buckets, and those at the truncated
    products are the first times of the later parts: two values, by which rows are told apart
    without a join. Rows without a time get no part.
    """
    times = df.select(spec.time).where(F.col(spec.time).isNotNull()).distinct()
    count = times.count()
    bounds = [int(count * train_ratio), int(count * (train_ratio + val_ratio))]
    ranked = with_row_index(times, replace(spec, series=()))
    firsts = {r[spec.index]: r[spec.time] for r in ranked.where(F.col(spec.index).isin(bounds)).collect()}
    part = F.when(F.col(spec.time).isNull(), None)
    for name, bound in zip(("train", "val"), bounds):
        before = F.col(spec.time) < F.lit(firsts[bound]).cast(df.schema[spec.time].dataType) if bound in firsts else F.lit(True)
        part = part.when(before, name)
    return df.withColumn("split", part.otherwise("test"))
