"""Reports over a station table: gaps, cadence, coverage, labels, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldsignal.functions.clock import MICROS_PER_SECOND, epoch_micros
from fieldsignal.operators.index import attach, by_hash, over_chunks, running_counts
from fieldsignal.session import materialize
from fieldsignal.spec import SeriesSpec

DAY_SECONDS = 86_400


def missing_report(df: DataFrame, spec: SeriesSpec, columns: Sequence[str] | None = None) -> DataFrame:
    """Per series and column with gaps: NULL count and percent, from one aggregation."""
    columns = list(columns or [c for c in df.columns if c not in spec.series])
    counted = df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return (
        counted.unpivot([*spec.keys, "total_rows"], columns, "column_name", "missing_count")
        .where("missing_count > 0")
        .withColumn("missing_pct", F.round(F.col("missing_count") / F.col("total_rows") * 100, 2))
    )


def with_step_micros(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Add ``step_us``: microseconds since the previous row of the series."""
    return over_chunks(
        df.withColumn("_us", epoch_micros(F.col(spec.time))),
        spec,
        1,
        0,
        lambda padded, w: padded.withColumn("step_us", F.col("_us") - F.lag("_us").over(w)),
    ).drop("_us")


def value_counts_of(df: DataFrame, spec: SeriesSpec, value: str) -> DataFrame:
    """How often each known value of a column stands in each series: (keys, value, ``n``)."""
    return df.where(F.col(value).isNotNull()).groupBy(*spec.keys, value).agg(F.count(F.lit(1)).alias("n"))


def exact_median(counts: DataFrame, spec: SeriesSpec, value: str) -> DataFrame:
    """Exact median of a LONG column per series, as DOUBLE ``median``, from its counted values.

    Counts per distinct value are ranked by ``running_counts``, so no task holds all the
    values of a series; the one or two middle values are then picked by rank.
    """
    totals = counts.groupBy(*spec.keys).agg(F.sum("n").alias("_total"))
    ranked = running_counts(counts, spec.keys, value, (1 << 36, 1 << 18))
    ranked = attach(ranked, totals, spec.keys, by_hash(value))

    def holds(rank: Column) -> Column:
        return (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))

    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    weight = holds(low).cast("int") + holds(high).cast("int")
    return (
        ranked.withColumn("_w", weight)
        .where("_w > 0")
        .groupBy(*spec.keys)
        .agg((F.sum(F.col(value) * F.col("_w")) / F.sum("_w")).alias("median"))
    )


def cadence_report(df: DataFrame, spec: SeriesSpec, default_seconds: float = 3600.0) -> DataFrame:
    """Median, smallest and largest step in seconds, and steps over twice the median.

    Steps are counted per distinct length once, and all figures come from the counts. A series of one
    row has no step; its median is the default.
    """
    step = "step_us"
    counts = materialize(value_counts_of(with_step_micros(df, spec).select(*spec.keys, step), spec, step))
    measured = attach(counts, exact_median(counts, spec, step), spec.keys, by_hash(step))
    report = measured.groupBy(*spec.keys).agg(
        F.max("median").alias("_median"),
        (F.min(step) / MICROS_PER_SECOND).alias("min_seconds"),
        (F.max(step) / MICROS_PER_SECOND).alias("max_seconds"),
        F.sum(F.when(F.col(step) > 2 * F.col("median"), F.col("n")).otherwise(0)).alias("_gaps"),
    )
    return df.select(*spec.keys).distinct().join(report, spec.keys, "left").select(
        *spec.keys,
        F.coalesce(F.col("_median") / MICROS_PER_SECOND, F.lit(default_seconds)).alias("median_seconds"),
        "min_seconds",
        "max_seconds",
        F.coalesce("_gaps", F.lit(0)).cast("long").alias("large_gaps"),
    )


def duplicate_count(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows beyond the first per (series, time)."""
    per_time = df.groupBy(*spec.keys, spec.time).agg(F.count(F.lit(1)).alias("n"))
    return per_time.groupBy(*spec.keys).agg(F.sum(F.col("n") - 1).alias("duplicate_rows"))


def coverage(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """First and last time per series, and the span in days and years."""
    spans = df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(spec.time).alias("coverage_start"),
        F.max(spec.time).alias("coverage_end"),
    )
    micros = epoch_micros(F.col("coverage_end")) - epoch_micros(F.col("coverage_start"))
    days = micros / (MICROS_PER_SECOND * DAY_SECONDS)
    return spans.withColumns({"coverage_days": days, "coverage_years": days / 365.25})


def label_list(df: DataFrame, spec: SeriesSpec, column: str = "source_year") -> DataFrame:
    """Distinct labels per series, sorted and joined by an ampersand."""
    distinct = df.select(*spec.keys, F.col(column).cast("string").alias("_label")).distinct()
    labels = F.array_join(F.sort_array(F.collect_set("_label")), " & ")
    return distinct.groupBy(*spec.keys).agg(
        F.when(labels == "", F.lit("available")).otherwise(labels).alias("labels")
    )


def outlier_report(df: DataFrame, spec: SeriesSpec, flag: str) -> DataFrame:
    return df.groupBy(*spec.keys).agg(
        F.count_if(F.col(flag)).alias("outliers"),
        F.count(F.lit(1)).alias("n_rows"),
        (F.count_if(F.col(flag)) / F.count(F.lit(1)) * 100).alias("outlier_pct"),
    )


def value_counts(df: DataFrame, spec: SeriesSpec, column: str) -> DataFrame:
    """Rows and percent per value, ranked by frequency, then by value.

    The window runs over the counted table, one row per distinct value.
    """
    counted = df.groupBy(*spec.keys, column).agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy(*spec.keys))
    order = Window.partitionBy(*spec.keys).orderBy(F.desc("n_rows"), F.col(column))
    return counted.withColumns(
        {"pct": F.col("n_rows") / total * 100, "rank": F.row_number().over(order).cast("long")}
    )


def split_spans(df: DataFrame, spec: SeriesSpec, split: str = "split") -> DataFrame:
    return df.groupBy(*spec.keys, split).agg(
        F.min(spec.time).alias("first_time"),
        F.max(spec.time).alias("last_time"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def preview(df: DataFrame, spec: SeriesSpec, n: int = 5) -> DataFrame:
    """First ``n`` rows in series and time order."""
    return df.orderBy(*spec.keys, spec.time).limit(n)


def shape(df: DataFrame) -> DataFrame:
    width = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(width).cast("long"))


def top_features(contributions: DataFrame, spec: SeriesSpec, n: int = 3) -> DataFrame:
    """``top_features``: per series the ``n`` features of largest mean absolute contribution, joined by commas.

    Contributions are averaged per (series, feature) first, so a series brings as many rows as there are features.
    """
    means = contributions.groupBy(*spec.keys, "feature").agg(F.avg(F.abs("contribution")).alias("_mean"))
    order = Window.partitionBy(*spec.keys).orderBy(F.desc("_mean"), "feature")
    best = means.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    ranked = F.sort_array(F.collect_list(F.struct("_rank", "feature")))
    return best.groupBy(*spec.keys).agg(F.array_join(F.transform(ranked, lambda x: x["feature"]), ", ").alias("top_features"))


def run_summary(
    cleaned: DataFrame,
    flagged: DataFrame,
    splits: DataFrame,
    metrics: DataFrame,
    advisories: DataFrame,
    spec: SeriesSpec,
    flag: str,
    labels: str = "source_year",
    contributions: DataFrame | None = None,
) -> DataFrame:
    """One row of headline figures per series, joined from small per-series reports; with
    contributions also the features that matter most."""
    spans = (
        split_spans(splits, spec)
        .groupBy(*spec.keys)
        .pivot("split", ["train", "val", "test"])
        .agg(F.first("first_time").alias("start"), F.first("last_time").alias("end"))
        .drop("val_start", "val_end")
    )
    test = metrics.where("split = 'test'").select(
        *spec.keys, "mae", "rmse", "r2", (F.col("r2") * 100).alias("r2_pct")
    )
    common = (
        value_counts(advisories, spec, "status")
        .where("rank = 1")
        .select(*spec.keys, F.col("status").alias("main_status"), F.col("pct").alias("main_status_pct"))
    )
    report = coverage(cleaned, spec)
    for part in (
        label_list(cleaned, spec, labels),
        outlier_report(flagged, spec, flag).drop("n_rows"),
        spans,
        test,
        common,
        *([] if contributions is None else [top_features(contributions, spec)]),
    ):
        report = report.join(part, spec.keys, "left")
    return report
