"""Attribution of predictions to features: per row, per feature, and summaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldsignal.functions import treeshap
from fieldsignal.operators.model import BoostedTrees, Fitted
from fieldsignal.session import ship_package
from fieldsignal.spec import SeriesSpec


def sample_rows(df: DataFrame, spec: SeriesSpec, n: int = 500, seed: int = 42) -> DataFrame:
    """A repeatable sample of ``n`` rows, or all rows if there are fewer: those with the
    smallest hash of key and seed."""
    order = F.md5(F.concat_ws(":", *spec.keys, spec.index, F.lit(seed)))
    return df.orderBy(order, *spec.keys, spec.index).limit(n)


def tree_leaves(model: BoostedTrees) -> list[treeshap.Leaf]:
    """Leaves of the model: rounds * leaves at most, fixed by the parameters of the fit.

    The mean label is a leaf of its own, that every row reaches.
    """
    found = [treeshap.Leaf(model.base, 1.0, (), (), (), ())]
    for tree in model.trees:
        nodes = {
            node: (
                value, *((2 * node, 2 * node + 1) if node in tree.feature else (-1, -1)),
                tree.feature.get(node, -1), tree.threshold.get(node), float(tree.rows[node]),
            )
            for node, value in tree.value.items()
        }
        found += treeshap.leaves_of(nodes, model.step)
    return found


def contributions(df: DataFrame, fitted: Fitted, spec: SeriesSpec) -> DataFrame:
    """One row per (series, position, feature): its value and contribution, and the base
    value all contributions of a row start from."""
    spark = df.sparkSession
    names = fitted.features
    leaves = tree_leaves(fitted.model)
    base = treeshap.base_value(leaves)
    keys = [*spec.keys, spec.index]
    numbers = T.ArrayType(T.DoubleType())
    fields = [*[df.schema[k] for k in keys], T.StructField("value", numbers), T.StructField("contribution", numbers)]

    def per_row(x: np.ndarray) -> pa.Array:
        ends = np.arange(0, x.size + 1, len(names), dtype=np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(x.ravel(), pa.float64(), from_pandas=True))

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(len(keys) + k).to_numpy(zero_copy_only=False) for k in range(len(names))]
            x = np.stack(columns, axis=1).astype(float)
            made = [*(batch.column(k) for k in range(len(keys))), per_row(x), per_row(treeshap.contributions(x, leaves))]
            yield pa.RecordBatch.from_arrays(made, names=[*keys, "value", "contribution"])

    ship_package(spark)
    rows = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in names]).mapInArrow(explain, T.StructType(fields))
    features = F.array(*[F.lit(c) for c in names]).alias("feature")
    # Rows stay whole between Python and Spark; only here they become one row for each feature.
    return rows.select(*keys, F.inline(F.arrays_zip(features, "value", "contribution")), F.lit(base).alias("base_value"))


def importance(parts: DataFrame, top: int | None = None) -> DataFrame:
    """Mean absolute contribution per feature, largest first; ``rank`` runs over the
    features, one row each."""
    means = parts.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
    order = Window.orderBy(F.desc("importance"), "feature")
    ranked = means.withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= top) if top else ranked


def explain_row(parts: DataFrame, spec: SeriesSpec, row: Column, top: int = 10) -> DataFrame:
    """Contributions of the rows that ``row`` picks, largest first; all beyond the first
    ``top - 1`` features are added up as ``other``."""
    keys = [*spec.keys, spec.index]
    order = Window.partitionBy(*keys).orderBy(F.desc(F.abs("contribution")), "feature")
    place = F.least(F.col("_place"), F.lit(top))
    return (
        parts.where(row)
        .withColumn("_place", F.row_number().over(order))
        .groupBy(*keys, place.cast("long").alias("rank"))
        .agg(
            F.when(F.count(F.lit(1)) > 1, F.lit("other")).otherwise(F.min("feature")).alias("feature"),
            F.sum("contribution").alias("contribution"),
        )
    )


def summary_points(parts: DataFrame, spec: SeriesSpec, top: int = 15) -> DataFrame:
    """Value and contribution pairs of the ``top`` features."""
    kept = importance(parts, top).select("feature", "rank")
    return parts.join(kept, "feature").select(*spec.keys, spec.index, "feature", "rank", "value", "contribution")
