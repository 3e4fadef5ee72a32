"""Connected components of a table of links."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldsignal.session import materialize


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root of every node of the links a, b: the root is the least node of the component.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its
    least one, then its smaller ones. The least neighbour is laid on buckets of a node's
    neighbours first, as many as the root of the number of links, so neither a bucket nor the
    buckets of a node with very many links make a large task; every round is written to the
    shared folder. Null ends link nothing.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before, size = None, edges.count()
    for _ in range(max_rounds):
        large = _with_least(edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))), size)
        large = large.where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = materialize(large.where("u <> v").distinct())
        small = _with_least(large, size)
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(small.where("u <> v").distinct())
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before, size = state, state["n"]
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _with_least(edges: DataFrame, size: int) -> DataFrame:
    """u, v, bucket and m, the least v of u, of every row."""
    buckets = math.isqrt(size) + 1
    dealt = edges.select("u", "v", F.pmod(F.xxhash64("v"), F.lit(buckets)).alias("bucket"))
    least = dealt.groupBy("u", "bucket").agg(F.min("v").alias("least"))
    laid = least.select("u", "bucket", F.min("least").over(Window.partitionBy("u")).alias("m"))
    return dealt.join(laid, ["u", "bucket"])
