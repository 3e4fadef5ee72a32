"""Writing tables, metrics and fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldsignal.functions.boosting import Tree
from fieldsignal.operators.model import BoostedTrees
from fieldsignal.spec import SeriesSpec


def write_series(df: DataFrame, path: str, spec: SeriesSpec, mode: str = "overwrite") -> None:
    """Parquet by month, clustered by series within each month.

    Clustering on (series, month, day) keeps the number of files per month small while a
    series that dominates the table is still spread over many tasks.
    """
    month = F.date_format(spec.time, "yyyy-MM")
    day = F.to_date(spec.time)
    (
        df.withColumn("month", month)
        .repartition("month", *spec.keys, day)
        .sortWithinPartitions("month", *spec.keys, spec.time)
        .write.mode(mode)
        .partitionBy("month")
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str, order: Sequence[str] = (), mode: str = "overwrite") -> None:
    """CSV with a header; ``order`` asks for range-sorted part files."""
    ordered = df.orderBy(*order) if order else df
    ordered.write.mode(mode).option("header", True).csv(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one per row of a metrics or summary table."""
    metrics.write.mode(mode).json(path)


def save_model(model: BoostedTrees, spark: SparkSession, path: str) -> None:
    """The nodes as a table, and one row with the feature names, the mean label and the step."""
    model.node_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    head = [(model.features, model.base, model.step, len(model.trees))]
    schema = "features array<string>, base double, step double, n_trees int"
    spark.createDataFrame(head, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/model")


def load_model(spark: SparkSession, path: str) -> BoostedTrees:
    head = spark.read.parquet(f"{path}/model").first()
    place = {name: k for k, name in enumerate(head["features"])}
    trees = [Tree() for _ in range(head["n_trees"])]
    # As many rows as the parameters of the fit allow: rounds * (2 * leaves - 1).
    for r in spark.read.parquet(f"{path}/nodes").collect():
        tree, node = trees[r["tree"]], r["node"]
        tree.value[node], tree.rows[node] = r["value"], r["n_rows"]
        if r["feature"] is not None:
            tree.feature[node], tree.threshold[node] = place[r["feature"]], r["threshold"]
            tree.gain[node] = r["gain"]
    return BoostedTrees(head["features"], head["base"], head["step"], trees)
