"""The whole flow: raw tables to clean signal, features, forecast, explanation, advice."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from fieldsignal.operators import (
    advise, attribute, clean, decompose, evaluate, features, hampel, model, profile, reconstruct, split,
)
from fieldsignal.session import materialize
from fieldsignal.sources import sinks, tables
from fieldsignal.spec import TARGET, SeriesSpec


@dataclass(frozen=True)
class FlowConfig:
    target: str = TARGET
    half_window: int = 12
    n_sigma: float = 3.0
    max_imfs: int = 7
    trials: int = 30
    horizon: int = 24
    train_ratio: float = 0.70
    val_ratio: float = 0.15
    boosting: model.BoostingParams = field(default_factory=model.BoostingParams)
    explained_rows: int = 500


@dataclass(frozen=True)
class FlowResult:
    cleaned: DataFrame
    flagged: DataFrame
    mode_statistics: DataFrame
    reconstructed: DataFrame
    splits: DataFrame
    fitted: model.Fitted
    metrics: DataFrame
    contributions: DataFrame
    advisories: DataFrame
    summary: DataFrame


def run(raw: list[DataFrame], spec: SeriesSpec, config: FlowConfig = FlowConfig()) -> FlowResult:
    """Run all stages on raw canonical tables. Tables that feed several later stages are
    written once, to the shared checkpoint folder."""
    t = config.target
    stacked = tables.union_all([clean.standardize(df) for df in raw])
    cleaned = materialize(clean.clean(stacked, spec, t))
    flagged = materialize(hampel.hampel(cleaned, spec, t, config.half_window, config.n_sigma))

    modes = decompose.ceemdan(flagged, spec, t, config.max_imfs, config.trials)
    statistics = reconstruct.select_modes(
        materialize(reconstruct.mode_statistics(modes, flagged, spec, t))
    )
    with_modes = decompose.attach_modes(flagged, modes, spec, config.max_imfs + 1)
    present = [c for c in with_modes.columns if c.startswith("imf_")]
    # A series with fewer modes than another has no energy in the missing ones.
    with_modes = with_modes.fillna(0.0, subset=present)
    rebuilt = materialize(reconstruct.attach_reconstruction(with_modes, modes, statistics, spec, t))

    featured, names, label = features.build_features(rebuilt, spec, t, config.horizon)
    splits = materialize(split.pooled_split(featured, spec, config.train_ratio, config.val_ratio))
    fitted = model.train(splits, names, label, config.boosting)
    scored = materialize(model.predict(fitted.model, splits))

    test = scored.where("split = 'test'")
    metrics = evaluate.evaluate(scored, [*spec.keys, "split"], label, "prediction")
    parts = materialize(
        attribute.contributions(attribute.sample_rows(test, spec, config.explained_rows), fitted, spec)
    )
    advised = advise.advisories(test, spec)
    summary = profile.run_summary(cleaned, flagged, scored, metrics, advised, spec, f"{t}_is_outlier", contributions=parts)
    return FlowResult(
        cleaned, flagged, statistics, rebuilt, splits, fitted,
        evaluate.evaluate(scored, ["split"], label, "prediction"), parts, advised, summary,
    )


def run_standard(spark: SparkSession, base: str, spec: SeriesSpec, config: FlowConfig = FlowConfig()) -> FlowResult:
    """The two yearly datasets below ``base``."""
    return run(list(tables.load_pair(spark, base)), spec, config)


def run_abnormal(spark: SparkSession, base: str, spec: SeriesSpec, config: FlowConfig = FlowConfig()) -> FlowResult:
    """The abnormal test table below ``base``."""
    return run([tables.load_abnormal(spark, base=base)], spec, config)


def save(result: FlowResult, out: str, spec: SeriesSpec) -> None:
    """Tables as Parquet, reports as CSV and JSON, the model with its feature names."""
    for name in ("cleaned", "flagged", "reconstructed"):
        sinks.write_series(getattr(result, name), f"{out}/processed/{name}", spec)
    sinks.write_csv(result.mode_statistics, f"{out}/reports/mode_statistics", [*spec.keys, "component"])
    sinks.write_csv(result.advisories, f"{out}/reports/advisories", [*spec.keys, "current_timestamp"])
    sinks.write_csv(attribute.importance(result.contributions), f"{out}/reports/importance", ["rank"])
    sinks.write_metrics(result.metrics, f"{out}/reports/metrics")
    sinks.write_metrics(result.summary, f"{out}/reports/summary")
    sinks.save_model(result.fitted.model, result.cleaned.sparkSession, f"{out}/models/forecast")
