"""Statistics of modes, selection of the informative ones, and the denoised signal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldsignal.functions.significance import p_value
from fieldsignal.operators.decompose import RESIDUE
from fieldsignal.spec import TARGET, SeriesSpec

# A mode is kept from this correlation or this share of energy on.
MIN_CORRELATION = 0.10
MIN_ENERGY_PCT = 1.0


def component_label(component: Column) -> Column:
    return F.when(component == RESIDUE, F.lit("Residue")).otherwise(F.format_string("IMF %d", component))


def mode_statistics(
    modes: DataFrame, df: DataFrame, spec: SeriesSpec, column: str = TARGET, significance: bool = True
) -> DataFrame:
    """Per series and component: variance, deviation, energy, energy share, correlation
    with the signal and its p-value, rounded for reporting."""
    signal = df.select(*spec.keys, spec.index, F.col(column).alias("_x"))
    v = F.col("value")
    sums = (
        modes.join(signal, [*spec.keys, spec.index])
        .groupBy(*spec.keys, "component")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.var_pop(v).alias("_var"),
            F.stddev_pop(v).alias("_std"),
            F.sum(v * v).alias("_energy"),
            F.covar_pop(v, "_x").alias("_cov"),
            F.stddev_pop("_x").alias("_std_x"),
        )
    )
    total = F.sum("_energy").over(Window.partitionBy(*spec.keys))
    share = F.when(total > 0, F.col("_energy") / total * 100).otherwise(0.0)
    # A constant mode or signal has no correlation.
    r = F.try_divide("_cov", F.col("_std") * F.col("_std_x"))
    stats = sums.withColumns({"_share": share, "_r": r})
    report = [
        F.round("_var", 4).alias("variance"),
        F.round("_std", 4).alias("std_dev"),
        F.round("_energy", 2).alias("energy"),
        F.round("_share", 2).alias("energy_pct"),
        F.round("_r", 4).alias("pearson_r"),
    ]
    if significance:
        p = p_value(F.col("_r"), F.col("_n"))
        report.append(F.round(p, 6).alias("p_value"))
    return stats.select(*spec.keys, "component", component_label(F.col("component")).alias("component_name"), *report)


def select_modes(
    statistics: DataFrame, min_correlation: float = MIN_CORRELATION, min_energy_pct: float = MIN_ENERGY_PCT
) -> DataFrame:
    """Add ``selected`` and ``reason``: the residue, and modes that follow the signal or
    carry energy, judged on the reported figures."""
    strength = F.coalesce(F.abs("pearson_r"), F.lit(0.0))
    informative = (strength >= min_correlation) | (F.col("energy_pct") >= min_energy_pct)
    residue = F.col("component") == RESIDUE
    r, e = F.round(strength, 3), F.round("energy_pct", 1)
    reason = (
        F.when(residue, "Residue Trend")
        .when(informative, F.format_string("|r|=%.3f >= %s or E%%=%.1f%%", r, F.lit(str(min_correlation)), e))
        .otherwise(F.format_string("High-frequency stochastic noise, |r|=%.3f, E%%=%.1f%%", r, e))
    )
    return statistics.withColumns({"selected": residue | informative, "reason": reason})


def reconstruct(modes: DataFrame, selection: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Sum of the selected modes per (series, position)."""
    chosen = selection.where("selected").select(*spec.keys, "component")
    return (
        modes.join(chosen, [*spec.keys, "component"], "left_semi")
        .groupBy(*spec.keys, spec.index)
        .agg(F.sum("value").alias("reconstructed"))
    )


def attach_reconstruction(
    df: DataFrame, modes: DataFrame, selection: DataFrame, spec: SeriesSpec, column: str = TARGET
) -> DataFrame:
    """Append the reconstructed signal and the noise it leaves out."""
    signal = reconstruct(modes, selection, spec).withColumnRenamed("reconstructed", f"{column}_reconstructed")
    noise = F.col(column) - F.col(f"{column}_reconstructed")
    return df.join(signal, [*spec.keys, spec.index], "left").withColumn(f"{column}_extracted_noise", noise)
