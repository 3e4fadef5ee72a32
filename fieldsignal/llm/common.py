"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldsignal.session import ship_package

#: Rows of an Arrow batch that goes to Python: long texts make larger batches a matter of memory.
BATCH_ROWS = 1_000
#: Upper-case and lower-case ASCII letters.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes to lower-cased word bytes, every other byte to a space: letters, digits and what is not ASCII.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, function: Callable[[Iterator], Iterator], schema: str | T.StructType) -> DataFrame:
    """mapInArrow in batches of bounded rows, with this package at hand in the workers."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(function, schema)


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def longs(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int64))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as keep it apart from the columns of df."""
    while name.lower() in {x.lower() for x in df.columns}:
        name = f"_{name}"
    return name


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is, for comparisons with ASCII words.

    The built-in lower() also changes other letters, but only two of them into ASCII.
    """
    odd = text.contains("\u212a") | text.contains("\u0130")
    return F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def same_key(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Join on columns of the same names, where null equals null; the left ones stay."""
    for name in names:
        right = right.withColumnRenamed(name, f"__right_{name}")
    on = None
    for name in names:
        part = left[name].eqNullSafe(right[f"__right_{name}"])
        on = part if on is None else on & part
    return left.join(right, on, how).drop(*(f"__right_{name}" for name in names))
